"""Secret scans with a randomness test battery, in DataFrame functions only.

Base kinds are fixed patterns (see KINDS). The offsets of all matches of a pattern follow from the text
between them: split() gives the pieces, regexp_extract_all() the matches, and their lengths add up.

The method looks at every longest piece of CANDIDATE_MIN or more characters of base64 or of base64url
that has a letter and a digit and does not overlap a base span. An equals sign belongs to a piece only
as padding, where nothing that could go on follows it: the value of name=value is a piece of its own.
Where a text mixes the two alphabets, as paths do, the pieces of either are looked at; pieces that are
called secret and overlap become one span. The smallest alphabet that holds all of a piece's characters
is its inferred encoding. Three tests ask whether its n symbols are uniform and independent:

* chi-squared uniformity over the alphabet, standardised with the exact mean and variance for n;
* the number of runs below and above the middle of the alphabet;
* the correlation of neighbouring symbols.

The smallest p-value times three is the battery's p-value; below UNIFORM_LEVEL a piece is no secret.
A fourth p-value is that of ordinary identifiers: how likely so few equal symbol pairs are among n
symbols of which two are equal with the probability REPEATS of the encoding. Short pieces cannot reach
small values, so the pieces are judged within classes of encoding and length: in each class, over all
rows, the Benjamini-Hochberg step-up rule keeps the expected share of ordinary identifiers among the
pieces that are called secret at FALSE_SHARE. Its cut-offs come from a histogram of p-values by class, a
table whose size does not depend on the input.

Defined results: null and empty texts have no spans; spans are in code points, the end exclusive;
spans of one start are in the order of the kinds; base spans of different kinds may overlap; repeated
rows are answered one by one, each counting in its class; an empty table gives no rows; a column spans
is replaced by the result, any other column stays, whatever its name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.common import unused_names
from tillgrain.session import stage

# The patterns of the contract, with letters in either case spelled out. The shortest
# length is part of the pattern where this cannot change which matches are found.
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    """["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = {"assign": _ASSIGN, "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}
ASSIGN_MIN = 12
RANDOM = "random"

CANDIDATE_MIN = 20
_PADDING = "(?:=+(?![A-Za-z0-9+/_=-]))?"
CANDIDATES = tuple(f"[A-Za-z0-9{more}]{{{CANDIDATE_MIN},}}{_PADDING}" for more in ("+/", "_-"))
UNIFORM_LEVEL = 0.001
FALSE_SHARE = 0.01
# Inferred encodings, the smallest first: pattern, alphabet, probability that two symbols of an
# ordinary identifier are equal.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef", 0.11),
    ("hex_upper", "^[0-9A-F]+$", DIGITS + "ABCDEF", 0.11),
    ("base32", "^[A-Z2-7]+=*$", UPPER + "234567", 0.065),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER, 0.065),
    ("base36_upper", "^[0-9A-Z]+$", DIGITS + UPPER, 0.065),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER, 0.055),
    ("base64", "^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/", 0.055),
    ("base64url", "^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_", 0.055),
)
LENGTH_CLASSES = 6  # lengths double from class to class
P_BINS = 200  # tenths of -log10(p)


SPAN_ARRAY = "array<struct<start:int,kind:int,end:int>>"
TOKEN_ARRAY = "array<struct<start:int,kind:int,end:int,token:string>>"
NOWHERE = 2**31 - 1  # behind every text
BLOCK = 64  # elements of an array that are walked with a growing list; see running()


def _with(value: Column, use) -> Column:
    """use(value), where the value is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(values: Column) -> Column:
    def cut(values: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
        return F.transform(firsts, lambda i: F.slice(values, i, F.lit(BLOCK)))

    return _with(values, cut)


def running(values: Column, combine, zero: int, levels: int = 2) -> Column:
    """For every integer of an array, all before it combined.

    A list that grows by one element is copied at each step, so only blocks of BLOCK elements are walked
    this way, and likewise the blocks' own totals: the time is linear up to BLOCK ** (levels + 1) elements
    and grows slowly beyond.
    """

    def walk(block: Column, start: Column) -> Column:
        none = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))

        def add(acc: Column, v: Column) -> Column:
            out = F.concat(acc["out"], F.array(acc["at"]))
            return F.struct(combine(acc["at"], v).alias("at"), out.alias("out"))

        return F.aggregate(block, none, add, lambda acc: acc["out"])

    if not levels:
        return walk(values, F.lit(zero))

    def over(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), lambda x, y: combine(x, y)))
        return F.flatten(F.zip_with(blocks, running(totals, combine, zero, levels - 1), walk))

    return _with(_blocks(values), over)


def spans(text: Column, pattern: str, kind: int, group_min: int = 0, tokens: bool = False) -> Column:
    """(start, kind, end) of all matches, those whose second group is shorter left out.

    With tokens the matches themselves stand in a fourth field.
    """

    def all_of(group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    # One more piece than matches: the last one comes with a null match.
    steps = F.zip_with(
        F.split(text, pattern, -1),
        all_of(0),
        lambda p, m: F.struct(
            F.length(p).alias("gap"),
            F.coalesce(F.length(m), F.lit(0)).alias("size"),
            m.alias("token"),
            m.isNotNull().alias("ok"),
        ),
    )
    if group_min:
        steps = F.zip_with(
            steps,
            all_of(2),
            lambda s, g: F.struct(
                s["gap"].alias("gap"),
                s["size"].alias("size"),
                s["token"].alias("token"),
                F.coalesce(F.length(g) >= group_min, F.lit(False)).alias("ok"),
            ),
        )

    def placed(step: Column, before: Column) -> Column:
        start = before + step["gap"]
        fields = [start.alias("start"), F.lit(kind).alias("kind"), (start + step["size"]).alias("end")]
        return F.struct(*fields, *([step["token"].alias("token")] if tokens else []), step["ok"].alias("ok"))

    def found(steps: Column) -> Column:
        before = running(F.transform(steps, lambda s: s["gap"] + s["size"]), lambda a, b: a + b, 0)
        return F.filter(F.zip_with(steps, before, placed), lambda s: s["ok"])

    fields = ("start", "kind", "end", "token") if tokens else ("start", "kind", "end")
    bare = F.transform(_with(steps, found), lambda s: F.struct(*(s[f].alias(f) for f in fields)))
    none = F.array().cast(TOKEN_ARRAY if tokens else SPAN_ARRAY)
    return F.when(text.rlike(pattern), bare).otherwise(none)


def upper_tail(z: Column) -> Column:
    """P(normal > z), by a logistic function that is right to about 2e-4; at least 1e-300."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(15.0), z))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _pick(index: Column, values: list) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index + 1)


def battery(tokens: Column) -> Column:
    """Structs with start, end and token, to structs with p_random, p_ordinary, class and bin."""
    # One split: a substring by its place would be sought from the start of the string each time.
    symbols = lambda x: F.transform(
        F.split(x["body"], ""), lambda c: F.position(c, x["alphabet"]) - 1
    )

    def inferred(x: Column) -> Column:
        kind = F.lit(None).cast("int")
        for k, (_, pattern, _, _) in reversed(list(enumerate(ENCODINGS))):
            kind = F.when(x["token"].rlike(pattern), k).otherwise(kind)
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.regexp_replace(x["token"], "=+$", "").alias("body"),
            kind.alias("encoding"),
        )

    def with_alphabet(x: Column) -> Column:
        alphabet = _pick(x["encoding"], [e[2] for e in ENCODINGS])
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["body"].alias("body"),
            x["encoding"].alias("encoding"),
            alphabet.alias("alphabet"),
            F.length(x["body"]).cast("double").alias("n"),
            F.length(alphabet).cast("double").alias("k"),
        )

    def with_codes(x: Column) -> Column:
        counts = F.transform(
            F.sequence(F.lit(1), F.length(x["alphabet"])),
            lambda i: F.length(x["body"])
            - F.length(F.replace(x["body"], F.substr(x["alphabet"], i, F.lit(1)), F.lit(""))),
        )
        pairs = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c.cast("double") * (c - 1) / 2)
        return F.struct(
            *(x[c].alias(c) for c in ("start", "end", "encoding", "n", "k")),
            symbols(x).alias("codes"),
            pairs.alias("pairs"),
        )

    def with_sums(x: Column) -> Column:
        codes = x["codes"]
        total = F.aggregate(codes, F.lit(0.0), lambda acc, c: acc + c)
        high = F.aggregate(codes, F.lit(0.0), lambda acc, c: acc + F.when(c >= x["k"] / 2, 1.0).otherwise(0.0))
        return F.struct(
            *(x[c].alias(c) for c in ("start", "end", "encoding", "n", "k", "codes", "pairs")),
            (total / x["n"]).alias("mean"),
            high.alias("high"),
        )

    def with_neighbours(x: Column) -> Column:
        above = lambda c: c >= x["k"] / 2
        zero = F.lit(0.0)
        first = F.struct(
            F.lit(None).cast("int").alias("last"), zero.alias("changes"), zero.alias("cross"), zero.alias("spread")
        )

        def add(acc: Column, c: Column) -> Column:
            last, off = acc["last"], c - x["mean"]
            changed = F.when(above(last) != above(c), 1.0).otherwise(0.0)
            cross = F.coalesce((last - x["mean"]) * off, zero)
            return F.struct(
                c.cast("int").alias("last"),
                (acc["changes"] + changed).alias("changes"),
                (acc["cross"] + cross).alias("cross"),
                (acc["spread"] + off * off).alias("spread"),
            )

        walked = F.aggregate(x["codes"], first, add)
        return F.struct(
            *(x[c].alias(c) for c in ("start", "end", "encoding", "n", "k", "pairs", "high")),
            walked.alias("walked"),
        )

    def with_serial(x: Column) -> Column:
        walked = x["walked"]
        return F.struct(
            *(x[c].alias(c) for c in ("start", "end", "encoding", "n", "k", "pairs", "high")),
            (walked["changes"] + 1).alias("runs"),
            F.when(walked["spread"] > 0, walked["cross"] / walked["spread"]).otherwise(1.0).alias("serial"),
        )

    def with_p(x: Column) -> Column:
        n, k = x["n"], x["k"]
        chi = 2 * x["pairs"] * k / n + k - n
        z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        middle = 1 + 2 * x["high"] * (n - x["high"]) / n
        spread = F.sqrt(F.greatest(F.lit(1e-9), (middle - 1) * (middle - 2) / (n - 1)))
        z_runs = F.abs(x["runs"] - middle) / spread
        z_serial = F.abs(x["serial"] + 1 / n) * F.sqrt(n)
        p = F.least(upper_tail(z_chi), 2 * upper_tail(z_runs), 2 * upper_tail(z_serial))
        repeats = _pick(x["encoding"], [e[3] for e in ENCODINGS])
        expected = n * (n - 1) / 2 * repeats
        p_ordinary = upper_tail((expected - x["pairs"]) / F.sqrt(expected))
        length_class = F.least(F.lit(LENGTH_CLASSES - 1), F.floor(F.log2(n / CANDIDATE_MIN)).cast("int"))
        length_class = F.greatest(F.lit(0), length_class)
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.least(F.lit(1.0), 3 * p).alias("p_random"),
            (x["encoding"] * LENGTH_CLASSES + length_class).cast("int").alias("class"),
            F.least(F.lit(P_BINS - 1), F.floor(-10 * F.log10(p_ordinary)).cast("int")).alias("bin"),
        )

    fits = lambda x: x["encoding"].isNotNull() & (F.length(x["body"]) >= CANDIDATE_MIN)
    tokens = F.filter(F.transform(tokens, inferred), fits)
    for step in (with_alphabet, with_codes, with_sums, with_neighbours, with_serial, with_p):
        tokens = F.transform(tokens, step)
    return tokens


def cut_offs(measured: DataFrame, runs: str) -> dict[int, int]:
    """For each class the smallest bin of p-values that the step-up rule still calls secret.

    A bin holds p-values up to 10 ** (-bin / 10), the bound with which it is judged.
    """
    bins = (
        measured.where(F.size(runs) > 0)
        .select(F.explode(runs).alias("r"))
        .groupBy(F.col("r.class").alias("class"), F.col("r.bin").alias("bin"))
        .count()
    )
    # At most classes x bins rows: the order below does not depend on the input's size.
    found: dict[int, dict[int, int]] = {}
    for row in bins.collect():
        found.setdefault(row["class"], {})[row["bin"]] = row["count"]
    out = {}
    for kind, counts in found.items():
        total, rank = sum(counts.values()), 0
        for b in sorted(counts, reverse=True):
            rank += counts[b]
            if 10 ** (-b / 10) * total <= FALSE_SHARE * rank:
                out[kind] = b
    return out


def united(found: Column) -> Column:
    """Spans of one kind, by start, those that overlap as one."""

    def heads(spans: Column) -> Column:
        """Spans that begin behind all before them, with where these end."""
        before = running(F.transform(spans, lambda s: s["end"]), F.greatest, 0)
        marked = F.zip_with(
            spans, before, lambda s, e: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), e.alias("before"))
        )
        return F.filter(marked, lambda s: s["start"] >= s["before"])

    def joined(spans: Column) -> Column:
        def closed(heads: Column) -> Column:
            ends = F.transform(F.slice(heads, F.lit(2), F.size(heads)), lambda h: h["before"])
            last = F.array(F.array_max(F.transform(spans, lambda s: s["end"])))
            return F.zip_with(
                heads,
                F.concat(ends, last),
                lambda h, e: F.struct(h["start"].alias("start"), h["kind"].alias("kind"), e.alias("end")),
            )

        return _with(heads(spans), closed)

    return _with(
        F.sort_array(found),
        lambda spans: F.when(F.size(spans) > 0, joined(spans)).otherwise(F.array().cast(SPAN_ARRAY)),
    )


def distinct_sorted(values: Column) -> Column:
    """The different elements of an array in order, by comparing neighbours."""

    def fresh(ordered: Column) -> Column:
        pairs = F.zip_with(
            ordered,
            F.slice(ordered, F.lit(2), F.size(ordered)),
            lambda a, b: F.struct(a.alias("a"), (b.isNull() | (a != b)).alias("last")),
        )
        return F.transform(F.filter(pairs, lambda p: p["last"]), lambda p: p["a"])

    return _with(F.sort_array(values), lambda v: F.when(F.size(v) > 1, fresh(v)).otherwise(v))


def clear_of(base: Column, runs: Column) -> Column:
    """Runs that overlap no base span: none before reaches over the start, none after starts inside."""

    def both(runs: Column) -> Column:
        fixed = F.transform(
            base,
            lambda b: F.struct(
                b["start"].alias("start"),
                F.lit(-1).alias("kind"),
                b["end"].alias("end"),
                F.lit(None).cast("string").alias("token"),
            ),
        )
        return F.sort_array(F.concat(fixed, runs))

    def free(ordered: Column) -> Column:
        is_base = lambda s: s["kind"] < 0
        ends = F.transform(ordered, lambda s: F.when(is_base(s), s["end"]).otherwise(0))
        starts = F.transform(F.reverse(ordered), lambda s: F.when(is_base(s), s["start"]).otherwise(NOWHERE))
        around = F.zip_with(
            running(ends, F.greatest, 0),
            F.reverse(running(starts, F.least, NOWHERE)),
            lambda a, b: F.struct(a.alias("before"), b.alias("after")),
        )
        checked = F.zip_with(
            ordered,
            around,
            lambda s, o: F.struct(
                s.alias("span"),
                (~is_base(s) & (o["before"] <= s["start"]) & (o["after"] >= s["end"])).alias("ok"),
            ),
        )
        return F.transform(F.filter(checked, lambda c: c["ok"]), lambda c: c["span"])

    def some(runs: Column) -> Column:
        return F.when((F.size(base) > 0) & (F.size(runs) > 0), _with(both(runs), free)).otherwise(runs)

    return _with(runs, some)


def scan_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Adds spans, an array of (start, kind, end), to the kept columns of docs(text)."""
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != "spans"]
    text_name, base_name, runs_name = unused_names(kept, "text", "base", "runs")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(
        *(
            spans(text, pattern, kind, ASSIGN_MIN if name == "assign" else 0)
            for kind, (name, pattern) in enumerate(KINDS.items())
        )
    )
    read = docs.select(*kept, text.alias(text_name), base.alias(base_name))
    pieces = F.concat(*(spans(F.col(text_name), pattern, len(KINDS), tokens=True) for pattern in CANDIDATES))
    mixed = F.filter(pieces, lambda x: x["token"].rlike("[0-9]") & x["token"].rlike("[A-Za-z]"))
    tokens = _with(F.col(base_name), lambda b: clear_of(b, distinct_sorted(mixed)))
    measured = read.withColumn(runs_name, battery(tokens)).drop(text_name)
    measured = stage(measured, "secrets-measured")
    cuts = cut_offs(measured, runs_name)
    cut = F.array(*(F.lit(cuts.get(k, P_BINS)) for k in range(len(ENCODINGS) * LENGTH_CLASSES)))
    random = F.transform(
        F.filter(
            runs_name,
            lambda r: (r["p_random"] >= UNIFORM_LEVEL) & (r["bin"] >= F.element_at(cut, r["class"] + 1)),
        ),
        lambda r: F.struct(
            r["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), r["end"].alias("end")
        ),
    )
    return measured.select(*kept, F.sort_array(F.concat(base_name, united(random))).alias("spans"))


def listed(found: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, [*KINDS, RANDOM]))
    return F.array_join(
        F.transform(
            found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark."""

    # Blocks of spans cut their part out of the text, spans cut theirs out of their block's.
    size = F.length(text)

    def marked(spans: Column, ends: Column) -> Column:
        pieces = F.zip_with(
            spans, ends, lambda s, e: F.struct(e.alias("at"), s["start"].alias("start"), F.greatest(e, s["end"]).alias("to"))
        )

        def cut(block: Column) -> Column:
            low = F.element_at(block, 1)["at"]

            def inside(part: Column) -> Column:
                return F.array_join(
                    F.transform(
                        block,
                        lambda p: F.when(p["start"] < p["at"], F.lit("")).otherwise(
                            F.concat(F.substr(part, p["at"] - low + 1, p["start"] - p["at"]), F.lit(mark))
                        ),
                    ),
                    "",
                )

            return _with(F.substr(text, low + 1, F.element_at(block, -1)["to"] - low), inside)

        return F.array_join(F.transform(_blocks(pieces), cut), "")

    def masked(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        rest = F.substr(text, F.array_max(ends) + 1, size)
        return F.concat(marked(spans, running(ends, F.greatest, 0)), rest)

    return F.when(F.size(found) > 0, _with(found, masked)).otherwise(text)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id with counts by base kind, the digest of the base spans, and all spans."""
    found = scan_secrets(docs, ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
