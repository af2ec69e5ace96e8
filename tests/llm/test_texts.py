"""Row-wise operators against brute force: licenses, quality, decontamination, BPE."""

import hashlib
import random
import re

import pytest
import regex

from tests.llm.cases import AWKWARD, documents, prose
from tillgrain.llm import bpe, decontaminate, licenses, quality

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDED_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# --- decontamination


def slow_hits(text, items, width=10):
    words, hit, found = FOLDED_WORD.findall(lower(text)), set(), set()
    for item, own in items:
        own = FOLDED_WORD.findall(lower(own))
        for i in range(max(1, len(own) - width + 1) if own else 0):
            window = own[i : i + width]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def benchmark_case():
    items = [(i, prose(100 + i, 5 + i)) for i in range(25)]
    items += [(25, None), (26, ""), (27, "?!"), (28, "Single"), (3, prose(900, 14)), (29, items[20][1])]
    texts = list(AWKWARD[:9])
    for i, (_, text) in enumerate(items[:25]):
        words = text.split()
        texts.append(f"{prose(i, 30)} {'; '.join(words[: 12 + i % 3]).upper()} {prose(i + 50, 20)}")
    texts += [items[20][1] + " " + items[20][1], "a single word", texts[12], texts[12]]
    return texts, items


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 60])
def test_decontamination_equals_brute_force(spark, block):
    texts, items = benchmark_case()
    table = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, texts)
    found = by_id(decontaminate.decontaminate(df, table, block_windows=block))
    assert set(decontaminate.RESULT.names) | set(df.columns) == set(found[0].asDict())
    for i, text in enumerate(texts):
        n, hit, own = slow_hits(text, items)
        row = found[i]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, hit, len(own), hit > 0)
        assert row.items_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert sum(len(FOLDED_WORD.findall(lower(text[a:b]))) for a, b in row.spans) == hit


def test_decontamination_of_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    df = documents(spark, ["a b c", None]).selectExpr("*", "1 AS spans", "'x' AS N_HIT", "2 AS other")
    rows = by_id(decontaminate.decontaminate(df, none))
    assert rows[0].n_hit == 0 and rows[1].n_words == 0 and rows[0].other == 2 and rows[0].spans == []
    assert decontaminate.decontaminate(documents(spark, []), none).count() == 0


# --- licenses


def slow_base(text):
    words = FOLDED_WORD.findall(lower(text))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), places, labels


def garbled(text, edits, seed):
    rng, out = random.Random(seed), list(text)
    for _ in range(edits):
        i = rng.randrange(1, len(out) - 1)
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = rng.choice("abcxyz")
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, rng.choice("abcxyz"))
    return "".join(out)


def test_license_base_equals_brute_force_and_method_only_adds(spark):
    texts = [*AWKWARD[:9], "MIT License.\nMIT, license; Apache License v2 GNU General Public License"]
    texts += ["submit licensed", "mit licenses", "the General-Public license mit license mit license", prose(3, 2000)]
    found = by_id(licenses.scan_licenses(documents(spark, texts)))
    for i, text in enumerate(texts):
        n, places, labels = slow_base(text)
        row = found[i]
        assert (row.n_words, row.n_base) == (n, len(places))
        assert (row.first_word, row.last_word) == ((min(places), max(places)) if places else (None, None))
        assert row.base_labels == ",".join(sorted(labels))
        assert labels <= set(row.labels.split(",")) | {""} or not labels
        assert 0 <= row.score <= 1 and (row.score == 0) == (row.labels == "")


@pytest.mark.parametrize("notice", list(licenses.NOTICES)[:8])
def test_notices_are_found_within_the_error_bound_and_reported_as_spans(spark, notice):
    bound = int(len(notice) * licenses.ERROR_SHARE)
    texts = [f"{prose(i, 40)}. É {garbled(notice, bound - i % 3, i)}, {prose(i + 9, 30)}" for i in range(6)]
    label, checked = licenses.NOTICES[notice], 0
    for i, row in by_id(licenses.scan_licenses(documents(spark, texts))).items():
        folded = " ".join(FOLDED_WORD.findall(lower(texts[i])))
        expected = regex.search(rf"\b(?:{notice}){{e<={bound}}}", folded)
        if not expected:  # a word that vanished left one edit more
            continue
        checked += 1
        assert label in row.labels.split(",")
        (match,) = [m for m in row.matches if m.label == label and m.edits > 0] or [row.matches[0]]
        assert texts[i][match.start : match.end].strip() == texts[i][match.start : match.end]
    assert checked >= 4


def fewest_edits(text, notice, bound):
    """(edits, start, end) of all stretches of whole words within the bound, by dynamic programming."""
    found = []
    for start in [i + 1 for i in range(len(text) - 1) if text[i] == " "]:
        costs = list(range(len(notice) + 1))
        for end in range(start, min(len(text) - 1, start + len(notice) + bound)):
            row = [costs[0] + 1]
            for q, c in enumerate(notice, 1):
                row.append(min(costs[q] + 1, row[-1] + 1, costs[q - 1] + (text[end] != c)))
            costs = row
            if costs[-1] <= bound and text[end + 1] == " ":
                found.append((costs[-1], start, end + 1))
    return found


def test_edits_at_both_ends_and_unequal_copies_are_found():
    scanner, rng = licenses.Scanner(), random.Random(4)
    apache = "licensed under the apache license version 2 0"
    cases = [(f"terms sub{apache} x", 3), (f"x{apache}y", 2), (f"{apache.replace('version', 'verzyon')} {apache}", 0)]
    cases += [(f"see {n}s now", 1) for n, label in licenses.NOTICES.items() if label in ("epl", "cc-by", "lgpl")]
    for text, edits in cases:
        assert min(e for *_, e in scanner.matches(f" {text} ")) == edits, text
    assert [e for *_, e in scanner.matches(f" {cases[2][0]} ")] == [2, 0]
    for seed in range(40):
        k = rng.randrange(len(scanner.notices))
        notice, _, bound = scanner.notices[k]
        copies = [garbled(f" {notice} ", rng.randint(0, bound + 1), seed * 9 + j) + prose(seed, j) for j in range(3)]
        text = f" {' '.join(' '.join(copies).split())} "
        got, wanted = [m for m in scanner.matches(text) if m[0] == k], fewest_edits(text, notice, bound)
        assert min((m[3] for m in got), default=None) == min((w[0] for w in wanted), default=None)
        assert all(any(a < end and start < b for _, a, b, _ in got) for _, start, end in wanted)
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:]))


def test_edits_count_characters_beyond_ascii_as_one(spark):
    texts = ["É É licénsed under the apáche license version 2 0 日本", "licénséd ündér thé apáché lícénsé vérsíon 2 0", None]
    found = by_id(licenses.scan_licenses(documents(spark, texts)))
    (match,) = found[0].matches
    assert (match.label, match.edits, texts[0][match.start : match.end]) == ("apache", 2, texts[0][4:-3])
    assert found[1].labels == found[2].labels == ""
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def test_clean_prose_has_no_license(spark):
    found = by_id(licenses.scan_licenses(documents(spark, [prose(i, 500) for i in range(20)])))
    assert all(r.labels == "" for r in found.values())


# --- quality


def slow_quality(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    chars = sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in set(windows) if windows.count(w) > 1} if len(words) < 3000 else None
    if twice is None:
        from collections import Counter

        twice = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), chars, symbols, dup, len(hit), failed


def slow_share(text, n):
    words = SPACE_WORD.findall(text or "")
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(n)}
    return sum(len(words[i]) for i in hit) / max(1, sum(map(len, words)))


def repeated_texts():
    parts = prose(4, 60)
    return [parts, f"{parts}\n{parts}", "\n".join([parts] * 5), "a b c a b c d a b", prose(6, 200) + " " + " ".join(prose(6, 200).split()[:25]), "x\nx\n \n \nÉ é#*\nÉ é#*"]


def test_quality_equals_brute_force(spark):
    texts = [*AWKWARD, *repeated_texts()]
    found = by_id(quality.quality(documents(spark, texts)))
    for i, text in enumerate(texts):
        row = found[i]
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
        assert got == slow_quality(text), i
        assert not (row.kept and row.base_failed)
    for i, text in enumerate(texts[10:], 10):
        for n in quality.LIMITS:
            assert found[i][f"dup_{n}gram_chars"] == pytest.approx(slow_share(text, n))
    assert found[9].kept and found[10].kept and not found[12].kept


def test_equal_hashes_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(quality, "rolling_hashes", lambda ids, n: np.zeros(len(ids) - n + 1, np.uint64))
    text = prose(8, 120) + " " + prose(8, 30)
    assert quality.measure(text.encode())[:5] == slow_quality(text)[:5]


# --- BPE


def test_bpe_equals_the_library(spark):
    library = tokenizers.Tokenizer.from_file(PATH)
    rng = random.Random(5)
    alphabet = [chr(i) for i in range(256)] + "th ing 's 'LL Σ ος İ ﬁ é 中 日本 😀 ² <|endoftext|> <|startoftext|> <|end K".split()
    alphabet += [" ", "\n", "　", "​", "é"]
    texts = [*AWKWARD, *("".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(400))]
    df = documents(spark, texts)
    found = by_id(bpe.digests(df, PATH))
    back = by_id(bpe.decode(bpe.encode(df, PATH), PATH))
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert back[i].ids == ids and back[i].decoded == decoded


def test_forgetting_pretokens_changes_nothing(monkeypatch):
    import pyarrow as pa

    texts = pa.array([prose(i, 300) for i in range(10)])
    wanted = list(bpe.Coder(PATH).code(texts))
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 500)
    assert list(bpe.Coder(PATH).code(texts)) == wanted
