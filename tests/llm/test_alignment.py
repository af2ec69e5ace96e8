"""Alignment of two tokenizers against the libraries run on whole texts, pair by pair."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import AWKWARD, documents, prose
from tillgrain.llm import alignment
from tillgrain.llm.perfect import PerfectHash

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
EMPTY = ((0,) * 6) + ("",)


def byte_of_symbol():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Libraries:
    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.symbols = byte_of_symbol()

    def spans(self, text):
        """(ids, bytes of each token) of both, or None."""
        a = self.a.encode(" " + text, add_special_tokens=False)
        a_bytes = [bytes(self.symbols[c] for c in t) for t in a.tokens]
        ids = self.b.encode(text)
        b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids
        ]
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return None
        return (a.ids, a_bytes), (ids, b_bytes)


def ends(tokens):
    return list(np.cumsum([len(t) for t in tokens]))


def slow(texts):
    libraries, per_text, counts = Libraries(), [], Counter()
    for text in texts:
        found = libraries.spans(text) if text else None
        if found is None:
            per_text.append(None)
            continue
        (a, a_bytes), (b, b_bytes) = found
        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):  # two tokens share bytes if each begins before the other ends
            links.append((a[i], b[j]))
            if a_ends[i] <= b_ends[j]:
                if a_ends[i] == b_ends[j]:
                    j += 1
                i += 1
            else:
                j += 1
        groups, common = [], sorted(set(a_ends) & set(b_ends))
        low = 0
        for end in common:
            groups.append(
                (
                    [x for x, e in zip(a, a_ends) if low < e <= end] if len(a) < 500 else None,
                    [x for x, e in zip(b, b_ends) if low < e <= end] if len(b) < 500 else None,
                )
            )
            low = end
        per_text.append((a, b, groups, links, a_ends, b_ends, common))
        counts.update(set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for found in per_text:
        if found is None:
            out.append(EMPTY)
            continue
        a, b, groups, links, a_ends, b_ends, common = found
        text = group_text(a, b, a_ends, b_ends, common)
        if groups[0][0] is not None and groups[0][1] is not None:
            assert text == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                len(a), len(b), len(common), len(links),
                sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return out, counts, best


def group_text(a, b, a_ends, b_ends, common):
    out, i, j = [], 0, 0
    for end in common:
        left, right = [], []
        while i < len(a) and a_ends[i] <= end:
            left.append(str(a[i]))
            i += 1
        while j < len(b) and b_ends[j] <= end:
            right.append(str(b[j]))
            j += 1
        out.append(",".join(left) + "|" + ",".join(right))
    return ";".join(out)


TEXTS = [
    *AWKWARD,
    "a ", " a", "a  b", "  ", "a \n", "\n a", "tab\tin it ", "a b c 　 d", "it's we'll DON'T 'ss 's",
    "<|endoftext|> <s>x</s> <unk> <0x41>", "a▁b", "x ▁ y", "▁", "x y▁ z", "ends with ▁", "a\x00b \x1c c\x85d", "é ﬁ Å",
    "😀😃 👩‍👩‍👧 中文字 русский العربية", "1234567 12 1 3.14", "----- ===== !!!???", "word" * 3000, "a b c " * 2000,
    prose(5, 400), prose(5, 400), prose(6, 10), "the the the", "zzqqxj " + "ő" * 300 + " end",
]


@pytest.fixture(scope="module")
def expected():
    return slow(TEXTS)


def found_rows(df):
    rows = sorted(df.collect(), key=lambda r: r.doc_id)
    return [tuple(r[c] for c in alignment.DIGESTS.names) for r in rows]


@pytest.mark.parametrize("case", [{}, {"section_pairs": 300}])
def test_digests_equal_the_libraries(spark, expected, case, monkeypatch):
    df = documents(spark, TEXTS).repartition(40)
    found = found_rows(alignment.digests(df, A_PATH, B_PATH, **case))
    assert found == expected[0]
    assert found[TEXTS.index("a▁b")] == EMPTY and found[0] == EMPTY


def test_small_bounds_change_nothing(spark, expected, monkeypatch):
    """In this process: units are forgotten, encoded in small pieces, texts taken one by one."""
    for name, value in {"REMEMBERED": 5, "JOINED_CHARS": 7, "CHUNK_CHARS": 10}.items():
        monkeypatch.setattr(alignment, name, value)
    import pyarrow as pa

    memory = alignment.Memory(alignment.aligner_of(A_PATH, B_PATH))
    sums, counts = [], Counter()
    for chunk in memory.chunks(pa.array(TEXTS)):
        sums += [tuple(memory.sums[d].sum(axis=0).tolist()[:4]) for d in chunk]
        for marks in (10**7, 0):
            monkeypatch.setattr(alignment, "MARKS", marks)
            pairs, n = alignment.pairs_of_documents(memory, chunk)
            counts.update(dict(zip(((p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()), n.tolist())))
    assert sums == [e[:4] for e in expected[0]]
    assert counts == {pair: 2 * n for pair, n in expected[1].items()}


def test_pair_counts_are_numbers_of_documents(spark, expected):
    rows = alignment.pair_counts(documents(spark, TEXTS).repartition(70), A_PATH, B_PATH).collect()
    _, counts, best = expected
    assert {(r.a, r.b): r.documents for r in rows} == counts and len(rows) == len(counts)
    assert all(r.best == (r.documents == best[r.a]) for r in rows)


def test_groups_join_to_the_digest(spark, expected):
    rows = alignment.token_groups(documents(spark, TEXTS), A_PATH, B_PATH).collect()
    for row, want in zip(sorted(rows, key=lambda r: r.doc_id), expected[0]):
        text = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in row.groups)
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == want[6]
        assert len(row.groups) == want[2]


def test_hot_pairs_come_together_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    df = documents(spark, ["the same text", "another one"] * 200).repartition(40)
    rows = alignment.pair_counts(df, A_PATH, B_PATH).collect()
    _, counts, _ = slow(["the same text", "another one"])
    assert {(r.a, r.b): r.documents for r in rows} == {p: 200 * n for p, n in counts.items()}


def test_empty_table_and_clashing_columns(spark):
    assert alignment.digests(documents(spark, []), A_PATH, B_PATH).count() == 0
    assert alignment.pair_counts(documents(spark, [None, ""]), A_PATH, B_PATH).count() == 0
    df = spark.createDataFrame([(1, "a b", 5, "x", 9)], "doc_id long, text string, N_A long, pairs string, bucket int")
    row = alignment.digests(df, A_PATH, B_PATH).first().asDict()
    assert (row["n_a"], row["pairs"], row["bucket"], row["text"]) == (2, "x", 9, "a b") and "N_A" not in row


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_numbers_each_key_once(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**62, n))
    perfect = PerfectHash.of(keys)
    assert sorted(perfect.numbers(keys)) == list(range(len(keys)))
    assert len(perfect.bits) * 8 <= 6 * n + 64
    others = perfect.numbers(keys + 1)
    assert ((others >= -1) & (others < max(n, 1))).all()
