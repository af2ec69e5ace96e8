"""BPE encoding by dynamic programming over prefixes, and decoding.

A pre-token is a string of symbols; the last symbol of a word carries the word end. For every prefix
of it there is exactly one token with which its BPE encoding can end: the token t that is a suffix of
the prefix and is compatible with the last token of the prefix before it. An automaton over the
vocabulary gives at each place the longest token that is a suffix, and each token has a link to the
next shorter one; the compatibility test says whether the merges would have joined symbols across the
border. The stored last tokens are followed backwards from the end and give the ids. New pre-tokens
are encoded in sorted order: what two neighbours have in common at the start is not computed again.

Two tokens a, b are compatible if no merge crosses the border: for a part x on the right edge of a and
a part y on the left edge of b, a merge x+y of rank m crosses if both parts are still there at that
time: m comes before the merge that takes x into a, and not after the one that takes y into b (equal
merges are made from left to right). Merges are made in the order of their ranks.

The tokenizer file is a parameter. What the library does around the merges is done here in the same
order: special tokens split the raw text, then NFC, lower case, splitting into pre-tokens (white space
is dropped), bytes as symbols. Decoding joins the tokens' strings by a space, as the library does for
a tokenizer without decoder.

Defined results: null and empty texts have no tokens; a pre-token of any length takes time linear in
its length; repeated rows are encoded one by one; an output column replaces an input column of its
name, other columns are kept.
"""

import functools
import hashlib
import json
import re
import unicodedata

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillgrain.llm.common import append_columns

REMEMBERED = 250_000  # pre-tokens a task keeps encoded; beyond it starts anew, results are the same

# The usual split of word tokenizers, and the same for texts of Latin-1 characters only, which the
# standard library matches several times faster. Used when the tokenizer file has just this pattern.
USUAL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS, NUMBERS, SPACES = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
LATIN_SPLIT = re.compile(
    rf"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+"
)
CHUNK_CHARS = 4_000_000  # texts are taken together up to about so many characters
END_MARK = 1024  # added to the number of a symbol that carries the word end
SYMBOL_BITS = 11
BEYOND_LATIN = re.compile("[^\x00-\xff]")

DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)
IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
DECODED = T.StructType([T.StructField("decoded", T.StringType())])


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the machine of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.id_of: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token_of = {i: t for t, i in [*self.id_of.items(), *self.special.items()]}
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        self.usual = self.split.pattern == USUAL_SPLIT
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.numbers = [ord(c) for c in byte_symbols()]
        self.rank: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = self.id_of[a], self.id_of[b]
            self.rank[left, right] = rank
            self.made_by.setdefault(self.id_of[a + b], (rank, left, right))
        self.right_edge = {i: self._edge(i, 2) for i in self.id_of.values()}
        self.left_edge = {i: self._edge(i, 1) for i in self.id_of.values()}
        self._build_automaton()
        self.fits = Fits(self)

    def _as_symbols(self, token: str) -> list[int]:
        """A token as numbers, with its word end folded into the last symbol."""
        if self.end and token.endswith(self.end) and token != self.end:
            body = [ord(c) for c in token[: -len(self.end)]]
            body[-1] += END_MARK
            return body
        return [ord(c) for c in token]

    def _build_automaton(self) -> None:
        """States are prefixes of tokens; goto, the longest token ending in a state, links."""
        self.goto: dict[int, int] = {}
        self.length: dict[int, int] = {}
        token_at, parent, symbol, depth = [-1], [0], [0], [0]
        for token, i in self.id_of.items():
            state, symbols = 0, self._as_symbols(token)
            for c in symbols:
                following = self.goto.setdefault(state << SYMBOL_BITS | c, len(parent))
                if following == len(parent):
                    parent.append(state)
                    symbol.append(c)
                    depth.append(depth[state] + 1)
                    token_at.append(-1)
                state = following
            token_at[state] = i
            self.length[i] = len(symbols)
        self.fall = [0] * len(parent)
        self.longest = token_at
        self.shorter: dict[int, int] = {}
        for state in sorted(range(1, len(parent)), key=depth.__getitem__):
            if parent[state]:
                self.fall[state] = self.step(self.fall[parent[state]], symbol[state])
            below = self.longest[self.fall[state]]
            if self.longest[state] < 0:
                self.longest[state] = below
            else:
                self.shorter[self.longest[state]] = below

    def step(self, state: int, symbol: int) -> int:
        """The state after a symbol; what is found by falling back is remembered."""
        key = state << SYMBOL_BITS | symbol
        found = self.goto.get(key)
        if found is None:
            found = self.step(self.fall[state], symbol) if state else 0
            if len(self.goto) < 4 * REMEMBERED:
                self.goto[key] = found
        return found

    def _edge(self, i: int, side: int) -> list[tuple[int, float]]:
        """Parts on one edge of a token, largest first, with the rank of the merge that took them."""
        out = [(i, float("inf"))]
        while i in self.made_by:
            made = self.made_by[i]
            i = made[side]
            out.append((i, made[0]))
        return out

    def compatible(self, a: int, b: int) -> bool:
        for x, taken_x in self.right_edge[a]:
            for y, taken_y in self.left_edge[b]:
                m = self.rank.get((x, y))
                if m is not None and m < taken_x and m <= taken_y:
                    return False
        return True

    def encode_sorted(self, words: list[str]):
        """Ids of each of the pre-tokens, which come in sorted order."""
        goto, step, longest, shorter = self.goto.get, self.step, self.longest, self.shorter
        length, fits, symbols = self.length, self.fits, self.numbers
        states, last, before, previous = [0], [-1], [0], []
        for word in words:
            new = [symbols[b] for b in word.encode()]
            if self.end:
                new[-1] += END_MARK
            same = 0
            for x, y in zip(previous, new):
                if x != y:
                    break
                same += 1
            del states[same + 1 :], last[same + 1 :], before[same + 1 :]
            for place in range(same, len(new)):
                key = states[place] << SYMBOL_BITS | new[place]
                state = goto(key)
                if state is None:
                    state = step(states[place], new[place])
                token = longest[state]
                start = place + 1 - length[token]
                while start and not fits[last[start] << 32 | token]:
                    token = shorter[token]
                    start = place + 1 - length[token]
                states.append(state)
                last.append(token)
                before.append(start)
            ids, at = [], len(new)
            while at:
                ids.append(last[at])
                at = before[at]
            ids.reverse()
            previous = new
            yield ids

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens and special tokens of a raw text, in order."""
        if not self.specials or not self.specials.search(text):
            return self._split(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [*self._split(text[at : m.start()]), m[0]]
            at = m.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        text = self.normal(text)
        fast = self.usual and not BEYOND_LATIN.search(text)
        return (LATIN_SPLIT if fast else self.split).findall(text)

    @staticmethod
    def normal(text: str) -> str:
        # Python lower-cases a capital sigma by its place in the word, the library does not.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Fits(dict):
    """Answers of the compatibility test, by both tokens in one number."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, pair: int) -> bool:
        if len(self) > 2 * REMEMBERED:
            self.clear()
        self[pair] = fits = self.vocabulary.compatible(pair >> 32, pair & 0xFFFFFFFF)
        return fits


@functools.lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    """One vocabulary for all tasks of a Python worker."""
    return Vocabulary(path)


class Coder:
    """Ids and tokens of texts as joined strings; remembers pre-tokens up to a bound."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary_of(path)
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}

    def learn(self, lists: list[list[str]]) -> None:
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.tokens.clear()
        if not self.ids:
            self.ids.update((t, str(i)) for t, i in self.vocabulary.special.items())
            self.tokens.update((t, t) for t in self.vocabulary.special)
        new: set[str] = set()
        for words in lists:
            new.update(words)
        new = sorted(new.difference(self.ids))
        token_of = self.vocabulary.token_of
        for word, ids in zip(new, self.vocabulary.encode_sorted(new)):
            self.ids[word] = " ".join([str(i) for i in ids])
            self.tokens[word] = " ".join([token_of[i] for i in ids])

    def code(self, texts):
        """(ids, tokens) of each text, in chunks of bounded size."""
        chunk, size = [], 0
        for text in texts:
            text = text.as_py() or ""
            chunk.append(self.vocabulary.pretokens(text))
            size += len(text)
            if size > CHUNK_CHARS:
                yield from self._joined(chunk)
                chunk, size = [], 0
        yield from self._joined(chunk)

    def _joined(self, lists: list[list[str]]):
        self.learn(lists)
        ids, tokens = self.ids.__getitem__, self.tokens.__getitem__
        for words in lists:
            yield " ".join(map(ids, words)), " ".join(map(tokens, words))


def digests(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """Columns DIGESTS for every row of docs(text): what the ids and the decoded text hash to."""

    def make():
        coder, sha = Coder(path), hashlib.sha256

        def compute(texts):
            counts, ids_sha, decoded_sha = [], [], []
            for ids, tokens in coder.code(texts):
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(sha(ids.encode()).hexdigest())
                decoded_sha.append(sha(tokens.encode()).hexdigest())
            return dict(zip(DIGESTS.names, (counts, ids_sha, decoded_sha)))

        return compute

    return append_columns(docs, make, ["text"], DIGESTS, keep)


def encode(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """Column ids for every row of docs(text)."""

    def make():
        coder = Coder(path)
        return lambda texts: {"ids": [list(map(int, ids.split())) for ids, _ in coder.code(texts)]}

    return append_columns(docs, make, ["text"], IDS, keep)


def decode(rows: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """Column decoded for every row of rows(ids): the strings of the tokens, joined by a space."""

    def make():
        tokens = vocabulary_of(path).token_of
        return lambda ids: {"decoded": [" ".join(tokens[i] for i in x or []) for x in ids.to_pylist()]}

    return append_columns(rows, make, ["ids"], DECODED, keep)
