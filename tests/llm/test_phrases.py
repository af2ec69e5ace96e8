"""Phrase mining against counting everything, whatever the sample proposes."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import AWKWARD, documents, prose
from tillgrain.llm import phrases
from tillgrain.llm.phrases import MIN_COUNT


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def all_counts(rows, max_words=3):
    found = defaultdict(Counter)
    for text, group in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                found["und" if group is None else group].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    return found


def slow_frequent(rows, min_count, max_words=3):
    out = {}
    for group, counts in all_counts(rows, max_words).items():
        out |= {(group, p): f for p, f in counts.items() if f >= min_count}
        n = sum(f for p, f in counts.items() if " " not in p)
        if n:
            out[group, ""] = n
    return out


def slow_collocations(rows, top=2000):
    out = set()
    for group, f in all_counts(rows).items():
        n, scored = sum(c for p, c in f.items() if " " not in p), []
        candidates = {p: a for p, a in f.items() if " " in p and a >= MIN_COUNT}
        for p, a in candidates.items():
            words = p.split(" ")
            score, k = min(
                (10**6 * a * a // (f[" ".join(words[:k])] * f[" ".join(words[k:])]), k) for k in range(1, len(words))
            )
            if not any(f" {p} " in f" {q} " and q != p and 100 * b >= 50 * a for q, b in candidates.items()):
                scored.append((-score, -a, p.encode(), p, f[" ".join(words[:k])], f[" ".join(words[k:])]))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((group, rank, p, -a, left, right, n, -s))
    return out


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    texts = list(AWKWARD)
    for i in range(n):
        text = prose(i, 120).split()
        for _ in range(8):
            at = rng.randrange(len(text))
            text[at:at] = rng.choice(["Old Stone Bridge", "red tape", "a a a a", "é ü", "x\ty", "old stone,bridge"]).split(" ")
        text = "".join(w + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c"]) for w in text)
        texts.append(text)
    texts += [texts[-1]] * 15
    return [(t, rng.choice(["en", "en", "de", None, "und", ""])) for t in texts]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def found_by(df):
    return {(r.lang, r.phrase): r.f for r in df.collect()}


@pytest.mark.parametrize(
    "case",
    [
        {},
        {"sample_one_in": 40},  # proposes little: the border fails
        {"sample_one_in": 10**9},  # proposes nothing
        {"max_bits": 64, "sample_one_in": 7},  # a filter that is far too small
        {"chunk": 40, "sample_one_in": 40, "max_words": 4, "min_count": 4},  # in many overlapping parts
        {"max_words": 1, "min_count": 3},
    ],
)
def test_counts_equal_counting_everything(spark, case, monkeypatch):
    monkeypatch.setattr(phrases, "MIN_BITS", 64)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 30_000)
    monkeypatch.setattr(phrases, "HELD_HASHES", 1000)
    rows = corpus()
    found = found_by(phrases.mine(frame(spark, rows), **case))
    assert found == slow_frequent(rows, case.get("min_count", MIN_COUNT), case.get("max_words", 3))


def test_each_phrase_is_counted_in_one_pass_only(spark):
    found = phrases.mine(frame(spark, corpus()), sample_one_in=30)
    assert found.count() == found.select("lang", "phrase").distinct().count()


def words_of(texts, group="g", overlap=2, limit=10**9):
    made = phrases.buffers((t.encode() for t in texts), overlap, limit)
    return [phrases.Words(group, buffer, carried) for buffer, carried in made]


def test_phrases_that_share_a_hash_are_counted_as_texts(spark, monkeypatch):
    """A filter that wants every hash, and likely hashes that say that each is shared."""
    rows = corpus()
    texts = phrases.grouped(frame(spark, rows))
    context = spark.sparkContext
    every = context.broadcast(np.full(64, 2**64 - 1, np.uint64))
    named = phrases.names_of_hashes(texts, 3, every, None, every)
    want = all_counts(rows)
    got = {(r.lang, r.phrase): r.hash for r in named.where("phrase <> ''").collect()}
    assert set(got) == {(g, p) for g, found in want.items() for p in found}
    assert len(set(got.values())) == len(got)
    counted = phrases.phrase_counts(texts, 3, every, None, every).groupBy("lang", "phrase").sum("n").collect()
    assert {(r[0], r[1]): r[2] for r in counted} == {(g, p): n for g, f in want.items() for p, n in f.items()}
    # One phrase is given the hash of another: both are counted again, and both counts are right.
    real = phrases.names_of_hashes
    (g, p), (_, q) = ("en", "red tape"), ("en", "tape")

    def confused(*args, **kwargs):
        found = real(*args, **kwargs)
        is_q = (found.lang == g) & (found.phrase == q)
        return found.withColumn("hash", F.when(is_q, F.lit(got[g, p])).otherwise(F.col("hash")))

    real_counts = phrases.phrase_counts

    def counting(*args, **kwargs):
        found = real_counts(*args[:4], every, **kwargs)
        is_q = (found.lang == g) & (found.phrase == q)
        return found.withColumn("hash", F.when(is_q, F.lit(got[g, p])).otherwise(F.col("hash")))

    monkeypatch.setattr(phrases, "names_of_hashes", confused)
    monkeypatch.setattr(phrases, "phrase_counts", counting)
    assert found_by(phrases.mine(frame(spark, rows), sample_one_in=1)) == slow_frequent(rows, MIN_COUNT)


def test_a_second_hash_tells_phrases_with_one_hash_apart():
    hashes, second = np.array([5, 7, 5, 5, 9], np.uint64), np.array([1, 2, 1, 3, 4], np.uint64)
    empty = np.empty(0, np.uint64)
    new, seen = phrases.unseen((empty, empty), hashes, second)
    assert sorted(new.tolist()) == [0, 1, 3, 4] and seen[0].tolist() == [5, 7, 9] and seen[1].tolist() == [1, 2, 4]
    new, seen = phrases.unseen(seen, np.array([9, 5, 6], np.uint64), np.array([4, 3, 8], np.uint64))
    assert sorted(new.tolist()) == [1, 2] and seen[0].tolist() == [5, 6, 7, 9]
    new, seen = phrases.unseen(seen, empty, empty)
    assert len(new) == 0


def test_hashes_of_words_and_phrases():
    a, b = words_of(["One  two\tone two. three", "", "x" * 70_000 + " one"]), words_of(["one two three x"], "h")
    (a,), (b,) = a, b
    assert [a.phrase(i, 1) for i in range(6)] == [b"one", b"two", b"one", b"two", b"three", b"x" * 70_000]
    assert a.hashes[0] == a.hashes[2] == a.hashes[6] and len(set(a.hashes.tolist())) == 4
    assert not set(a.hashes.tolist()) & set(b.hashes.tolist())  # groups have hashes of their own
    assert a.joined.tolist() == [True, True, True, False, False, True, False]
    assert a.phrase(1, 3) == b"two one two"
    assert a.second_hashes(np.array([0, 2]), 2).tolist() == [a.second_hashes(np.array([0]), 2)[0]] * 2
    assert words_of([" .,", ""])[0].hashes.tolist() == [] and words_of([]) == []


def test_a_failure_of_the_border_starts_another_pass(spark, monkeypatch):
    passes = []
    counted = phrases.names_of_hashes
    monkeypatch.setattr(phrases, "names_of_hashes", lambda *a, **k: passes.append(a) or counted(*a, **k))
    phrases.mine(frame(spark, corpus()), sample_one_in=10**9)
    assert len(passes) == 3  # one pass for each length
    passes.clear()
    phrases.mine(frame(spark, corpus()), sample_one_in=1)
    assert len(passes) == 1


def test_collocations_equal_brute_force(spark):
    rows = corpus(4, 90)
    found = {tuple(r) for r in phrases.digests(frame(spark, rows)).collect()}
    assert found == slow_collocations(rows) and len(found) > 20
    three = phrases.collocations(phrases.mine(frame(spark, rows)), top=3)
    assert {tuple(r) for r in three.collect()} == {r for r in slow_collocations(rows) if r[1] <= 3}


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 3_000_000_017, 4_000_000_007, 5_000_000_029
    rows = [("g", "u v", 2, a), ("g", "u", 1, left), ("g", "v", 1, right), ("g", "", 0, 10**12)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    row = phrases.collocations(frequent).first()
    assert row.score == 10**6 * a * a // (left * right) and (row.a, row.l, row.r, row.n) == (a, left, right, 10**12)


def test_a_covered_phrase_goes_and_its_cover_may_go_too(spark):
    f = {"a b": 10, "b c": 30, "c d": 20, "a b c": 5, "b c d": 15, "a b c d": 15}
    rows = [("g", p, len(p.split()), n) for p, n in f.items()] + [("g", w, 1, 100) for w in "abcd"]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    stays = phrases.uncovered(phrases.scored(frequent))
    # "a b" is covered by "a b c" at just half, "b c" by "b c d", which "a b c d" covers in turn.
    assert {r.phrase for r in stays.collect()} == {"a b c d"}


def test_empty_tables_and_other_columns(spark):
    assert phrases.digests(frame(spark, [])).count() == 0
    assert phrases.digests(documents(spark, [None, "", " ", ".,;"])).count() == 0
    rows = [(t, g, "x", 7) for t, g in corpus()]
    df = spark.createDataFrame(rows, "text string, lang string, phrase string, n int")
    assert found_by(phrases.mine(df)) == slow_frequent([r[:2] for r in rows], MIN_COUNT)


def test_parts_of_a_long_text_overlap():
    texts = ["one two three. four\tfive " * 50, "six", " a " + "b" * 100 + " c"]
    for overlap in (0, 2, 3):
        parts, (whole,) = words_of(texts, overlap=overlap, limit=37), words_of(texts, overlap=overlap)
        assert len(parts) > 20 and parts[0].carried == 0 and {w.carried for w in parts[1:]} <= {0, 1, overlap}
        own = [w.phrase(i, 1) for w in parts for i in range(w.carried, len(w))]
        assert own == [whole.phrase(i, 1) for i in range(len(whole))]
        assert max(len(w) for w in parts) < 20
