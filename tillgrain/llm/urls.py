"""Verdicts on urls by pattern rules, of which only a few are tried on each url.

A rule is found by one of its literal tokens: the one that the fewest urls of the table hold, counted
over all of them. The tokens of a url fetch the rules that are filed under them, and only these run
their regular expressions, in the order of their precedence until one matches. A rule whose pattern
has no token that is whole in every url it matches is tried on all urls.

Patterns: "||" at the start is the start of the host or of one of its parent domains, "|" at the start
or the end is that of the url, "^" is any character but letters, digits and _ . % -, or the end, "*" is
anything, and all else stands for itself. They are matched, case included, with the host in lower
case and what follows it; the scheme is not matched.

Of the rules that match, named ones come before others, longer names before shorter ones, of equally
long ones the longer host; among rules without a name "allow" comes before "block". A url that no rule
matches is allowed.

The rules are a parameter of the job, not data: they are held by the driver and sent to every task.
What the driver collects is one number for each of their tokens.

Defined results: null urls and urls without "://" have an empty host and path, no rule, and are
allowed; urls of any length are matched whole; repeated urls are judged one by one; an empty table
gives no rows; an output column replaces an input column of its name, other columns are kept.
"""

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns

ALLOW, BLOCK = "allow", "block"
TOKEN = re.compile("[0-9a-z]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
AUTHORITY = re.compile("[/?#]")
QUERY = re.compile("[?#]")
SIGNS = {"*": ".*", "^": r"(?:[^0-9A-Za-z_.%-]|\Z)"}

VERDICT = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """A pattern and its verdict; a name says that the rule is given in results."""

    verdict: str
    pattern: str
    name: str | None = None

    def order(self) -> tuple:
        """Rules that come first decide."""
        name = self.name or ""
        return (self.name is None, -len(name), name.find("/"), self.verdict != ALLOW, self.pattern)

    def regex(self) -> re.Pattern:
        body, start, end = self.pattern, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"\A(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], r"\A"
        if body.endswith("|"):
            body, end = body[:-1], r"\Z"
        return re.compile(start + "".join(SIGNS.get(c) or re.escape(c) for c in body) + end, re.DOTALL)

    def tokens(self) -> list[str]:
        """Literal tokens that every matching url holds as whole tokens.

        A token at an open end of the pattern or beside "*" may be a piece of a longer one in the url.
        """
        text = self.pattern.translate(ASCII_LOWER)
        return [
            m[0]
            for m in TOKEN.finditer(text)
            if m.start() > 0 and text[m.start() - 1] != "*"
            and m.end() < len(text) and text[m.end()] != "*"
        ]


def domain_rule(verdict: str, name: str) -> Rule:
    """The rule of a name host/path: its host and all subdomains, paths that start with its path."""
    return Rule(verdict, "||" + name, name)


# The rules with names.
DOMAINS = [
    domain_rule(BLOCK, "net/"),
    domain_rule(ALLOW, "example.net/en/"),
    domain_rule(BLOCK, "example.com/de/"),
    domain_rule(ALLOW, "org/fr/"),
]
# Places that hold no text of their own (adverts, accounts, shops, searches, continued
# lists, files that are not pages), and what is a page of text all the same.
BLOCKED = [
    "||ad.", "||ads.", "||adserver.", "||track.", "||pixel.", "||doubleclick.",
    "/wp-login.php", "/wp-admin/", "/xmlrpc.php", "/cgi-bin/", "/cart^", "/checkout^", "/basket^",
    "/login^", "/signin^", "/logout^", "/register^", "/search?", "^page=", "^replytocom=", "^sessionid=",
    "^phpsessid=", "/casino/", "/porn/", ".jpg|", ".png|", ".gif|", ".zip|", ".exe|", ".css|", ".js|",
]
ALLOWED = ["||docs.", "/wiki/", "/help/login^", "^page=1&", "^page=1|"]
RULES = [
    *DOMAINS,
    *(Rule(BLOCK, pattern) for pattern in BLOCKED),
    *(Rule(ALLOW, pattern) for pattern in ALLOWED),
]


def parts(url: str | None) -> tuple[str, str]:
    """Host in lower case, and what follows it."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = AUTHORITY.search(rest)
    cut = end.start() if end else len(rest)
    return rest[:cut].translate(ASCII_LOWER), rest[cut:]


def url_tokens(subject: str) -> set[str]:
    return set(TOKEN.findall(subject.translate(ASCII_LOWER)))


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many rows of urls(url) hold each token of the rules; tokens that none holds are left out."""
    wanted = {token for rule in rules for token in rule.tokens()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for url in batch.column(0).to_pylist():
                held.update(url_tokens("".join(parts(url))) & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
            names=["token", "n"],
        )

    counted = urls.select("url").mapInArrow(count, "token string, n long")
    return {r["token"]: r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class RuleIndex:
    """Rules in the order of precedence, filed by their rarest token."""

    def __init__(self, rules: Iterable[Rule], counts: dict[str, int]):
        self.rules = sorted(rules, key=Rule.order)
        self.regexes = [rule.regex().search for rule in self.rules]
        self.filed: dict[str, list[int]] = {}
        self.everywhere: list[int] = []
        for number, rule in enumerate(self.rules):
            tokens = rule.tokens()
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), t))
                self.filed.setdefault(rarest, []).append(number)
            else:
                self.everywhere.append(number)

    def candidates(self, subject: str) -> list[int]:
        numbers = list(self.everywhere)
        for token in self.filed.keys() & url_tokens(subject):
            numbers += self.filed[token]
        return sorted(numbers)

    def first_match(self, subject: str) -> Rule | None:
        for number in self.candidates(subject):
            if self.regexes[number](subject):
                return self.rules[number]
        return None


def judge(
    pages: DataFrame, rules: Sequence[Rule] = tuple(RULES), keep: list[str] | None = None
) -> DataFrame:
    """Columns VERDICT for every row of pages(url)."""
    rules = list(rules)
    counts = token_counts(pages, rules)

    def make():
        index = RuleIndex(rules, counts)

        def compute(urls):
            out: list[tuple] = []
            for url in urls.to_pylist():
                host, rest = parts(url)
                rule = index.first_match(host + rest) if host or rest else None
                path = QUERY.split(rest, maxsplit=1)[0]
                out.append((host, path, rule and rule.name, rule.verdict if rule else ALLOW))
            return dict(zip(VERDICT.names, map(list, zip(*out))))

        return compute

    return append_columns(pages, make, ["url"], VERDICT, keep)
