"""HTML extraction, sharding and the pipeline."""

import itertools
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.cases import AWKWARD, documents, prose
from tillgrain.llm import html, sharding

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/'>Menu</a></li></ul></nav><!-- note --><div class=ad>Buy</div>"
    "<article><h1>Head &amp; more</h1><p><b>One.<br><p>Two  &lt;x&gt;\n three</p><div class='comments'>No</div>"
    "<form>field</form></article><footer>&copy; host</footer></body>"
)


def texts_of(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html.extract(df, ["page_id", "url"]).collect()}


def test_article_without_what_surrounds_it(spark):
    pages = [(0, "http://a.example/x", PAGE), (1, None, None), (2, "bad", ""), (3, "http://a.example/y", "just text &eacute;")]
    pages += [(4, "http://b.example", "<p>open <i>it"), (5, "http://b.example", "<article><p>x<!-- never closed"), (6, "u", "<div>" * 3000 + "deep")]
    found = texts_of(spark, pages)
    assert found[0] == "Head & more\n\nOne.\n\nTwo <x> three"
    assert found[1] == found[2] == "" and found[3] == "just text é"
    assert found[4] == "open it" and found[5] == "x" and found[6] == "deep"


def test_names_are_noise_as_a_whole_only():
    kept = "with-sidebar page-no-comments share-price advert-law related-work entry-header market-share has-menu no-ad adventure".split()
    gone = "ad sidebar site-footer main-nav cookie-notice comment-list share-buttons related-posts menu-item-12 article-sidebar left_sidebar".split()
    assert [n for n in kept if html.is_noise_name(n)] == [] and [n for n in gone if not html.is_noise_name(n)] == []
    wrapped = "<div class='layout sidebar'><div id=page-no-comments><main><p class=share-price>A</p><h2 id=comments>B</h2></main></div></div>"
    assert html.Page(wrapped).main_text() == "A\n\nB"
    page = "<div class=sidebar>no<p>no</div><section id=related-work>C <span class=share-buttons>x</span>D</section><div class=comment-list><article>E</article></div>"
    assert html.Page(page).main_text() == "C D"


def test_unclosed_tags_take_linear_time_and_room(spark):
    import time

    def seconds(source):
        start = time.perf_counter()
        page = html.Page(source)
        nodes, text = list(page.nodes()), page.main_text(frozenset((1,)))
        return time.perf_counter() - start, len(nodes), text

    for tags in ("<div>a", "<li>a", "<span>a", "</b><div>a", "<div class=menu>a<main>b"):
        n = 200_000 // len(tags)
        seconds(tags * 100)
        took, nodes, text = seconds(tags * n)
        assert took < 20 and nodes <= 2 * n and len(text) >= n
    pages = [(i, "http://h.example", "<div>a" * 3000 + str(i)) for i in range(4)]
    assert texts_of(spark, pages)[0].endswith("a0")


def test_no_pages_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    schema = "page_id long, url string, html string"
    assert html.extract(spark.createDataFrame([], schema), ["page_id"]).count() == 0
    names = ["_low", "_host", "_salt", "salt", "_paths", "host", "paths"]
    pages = spark.createDataFrame([(i, "http://h.example", templated(i, 0)) for i in range(9)], schema)
    found = html.extract(pages.withColumns({c: F.lit(c) for c in names}), ["page_id", *names])
    for r in found.collect():
        assert [r[c] for c in names] == names and r.text == f"{prose(r.page_id, 30)}\n\n{prose(r.page_id + 500, 20)}"


def templated(i, host):
    return (
        f"<html><body><div id=top>Welcome to our site</div><div id=body><p>{prose(i, 30)}</p>"
        f"<p>{prose(i + 500, 20)}</p></div><div id=end>All rights reserved</div></body></html>"
    )


@pytest.mark.parametrize("bound", [html.BROADCAST_HOSTS, 0])
def test_what_all_pages_of_a_host_share_is_removed(spark, monkeypatch, bound):
    monkeypatch.setattr(html, "BROADCAST_HOSTS", bound)
    pages = [(i, f"http://h{i % 2}.example/{i}", templated(i, i % 2)) for i in range(20)]
    pages += [(100 + i, "http://h0.example/copy", pages[0][2]) for i in range(50)]
    pages.append((999, "http://single.example", templated(7, 9)))
    found = texts_of(spark, pages)
    for i in range(20):
        assert found[i] == f"{prose(i, 30)}\n\n{prose(i + 500, 20)}"
    assert all(found[100 + i] == found[0] for i in range(50))
    assert found[999].startswith("Welcome")


def test_template_branches_inside_of_main_are_removed(spark):
    pages = []
    for i in range(12):
        body = f"<article><h1>{prose(i, 4)}</h1><p>{prose(i + 50, 30)}</p></article>" if i % 2 else f"<p>{prose(i, 30)}</p>"
        page = f"<main><header>Our site</header><div class=top>Welcome</div>{body}<div class=end>All rights</div></main>"
        pages.append((i, f"http://h.example/{i}", f"<html><body>{page}</body></html>"))
    pages.append((99, "http://single.example", pages[1][2]))
    found = texts_of(spark, pages)
    for i in range(12):
        assert found[i] == (f"{prose(i, 4)}\n\n{prose(i + 50, 30)}" if i % 2 else prose(i, 30))
    assert found[99].startswith("Our site\n\nWelcome")


def test_teaser_articles_do_not_replace_the_body(spark):
    pages = []
    for i in range(12):
        teasers = f"<article class=t><p>{prose(i + 70, 4)}</p></article><article class=s><p>Read all of it</p></article>"
        pages.append((i, f"http://h.example/{i}", f"<div class=top>Welcome</div><div class=text><p>{prose(i, 60)}</p></div>{teasers}"))
        pages.append((50 + i, f"http://g.example/{i}", f"<div>{prose(i, 9)}</div><article><p>{prose(i + 30, 60)}</p></article>"))
    found = texts_of(spark, pages)
    for i in range(12):
        assert found[i] == f"{prose(i, 60)}\n\n{prose(i + 70, 4)}"
        assert found[50 + i] == prose(i + 30, 60)


def test_synthetic_pages_keep_exactly_the_article(spark):
    import re
    from html import unescape

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in html.extract(df.select("page_id", "url", "html"), ["page_id", "url"]).collect()}
    for page in df.collect():
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        parts = [re.sub("<[^>]*>", " ", x) for x in re.split("</?(?:h1|p)>", article)]
        wanted = "\n\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        assert found[page.page_id].text == wanted and found[page.page_id].n_chars == len(wanted)


def slow_cost(supplies, room):
    """Least moved bytes by trying all integer flows of a tiny network."""
    best = None
    splits = [
        [x for x in itertools.product(range(s + 1), repeat=len(room)) if sum(x) == s] for s in supplies
    ]
    for choice in itertools.product(*splits):
        if all(sum(c[j] for c in choice) <= room[j] for j in range(len(room))):
            cost = sum(c[j] for i, c in enumerate(choice) for j in range(len(room)) if i != j)
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("supplies, room", [([4, 2], [2, 2, 2]), ([3, 3, 0], [2, 2, 2]), ([1, 5], [3, 1, 3]), ([0, 6], [6, 0])])
def test_flow_moves_the_fewest_bytes(supplies, room):
    flow = sharding.cheapest_flow(supplies, room, lambda a, b: int(a != b))
    assert [sum(f for (a, _), f in flow.items() if a == i) for i in range(len(supplies))] == supplies
    assert all(sum(f for (_, b), f in flow.items() if b == j) <= room[j] for j in range(len(room)))
    assert sum(f for (a, b), f in flow.items() if a != b) == slow_cost(supplies, room)


def test_shards_are_even_gapless_and_complete(spark):
    texts = [*AWKWARD[:8], *(prose(i, 5 + i % 200) for i in range(1500)), *[prose(1, 50)] * 400]
    df = documents(spark, texts).unionByName(documents(spark, ["twice"])).unionByName(documents(spark, ["twice"]))
    rows = sharding.digests(df).collect()
    assert len(rows) == len(texts) + 2 and {r.law for r in rows} == {"bytes"}
    assert all(r.grown_shard is None and 0 <= r.shard < 40 for r in rows)
    bytes_of, slots = Counter(), defaultdict(list)
    for r in rows:
        bytes_of[r.shard] += r.size
        slots[r.shard].append(r.slot)
        text = texts[r.doc_id] or "" if r.text_crc32 != zlib.crc32(b"twice") else "twice"
        assert (r.size, r.text_crc32) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(bytes_of.values()) - min(bytes_of.values()) <= max(r.size for r in rows)
    assert max(bytes_of.values()) <= 1.02 * sum(bytes_of.values()) / 40


def test_a_long_text_has_a_shard_for_itself_and_empty_tables_work(spark):
    rows = sharding.digests(documents(spark, ["x" * 100_000, *["y" * 100] * 500])).collect()
    whale = next(r for r in rows if r.size > 90_000)
    assert sum(r.shard == whale.shard for r in rows) == 1
    assert sharding.digests(documents(spark, [])).count() == 0


def test_rewriting_touches_only_affected_shards(spark, tmp_path):
    df = spark.range(400).selectExpr("id AS doc_id", "100L AS size", "id AS text_crc32")
    rows = sharding.in_old_shards(df, 4, 8)
    rows.write.partitionBy("old_shard").parquet(str(tmp_path / "old"))
    placed = sharding.plan(rows, 5)
    manifest = sharding.rewrite(rows, placed, str(tmp_path / "old"), str(tmp_path / "new")).collect()
    assert sorted(r.shard for r in manifest) == [0, 1, 2, 3, 4]
    found = spark.read.parquet(str(tmp_path / "new"))
    moved = {r.shard for r in placed.where("old_shard <> shard").collect()} | {r.old_shard for r in placed.where("old_shard <> shard").collect()}
    assert {r.shard for r in found.select("shard").distinct().collect()} == moved
    wanted = rows.join(placed, ["old_shard", "block"]).where(placed["shard"].isin(*moved))
    assert found.count() == wanted.count()


# --- pipeline


def test_pipeline_keeps_clean_documents_and_rejects_the_rest(spark, tmp_path):
    items = [prose(300 + i, 25) for i in range(3)]
    clean = [prose(i, 80) for i in range(12)]
    texts = [
        *clean,
        clean[0],  # 12 copy
        clean[1] + " end",  # 13 near copy
        prose(50, 60) + " " + items[0] + " " + prose(51, 60),  # 14 leak
        prose(52, 60) + " password = abcdefgh12345678 " + prose(53, 60),  # 15 secret
        None,
        "",
        "1234 !!",
        clean[0],
    ]
    df = documents(spark, texts).unionByName(documents(spark, [clean[0]]))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, str(tmp_path))
        kept[name] = sorted(r.doc_id for r in docs.collect())
        if name != "bpe_coding":
            assert docs.columns == df.columns
        if name == "mask_secrets":
            masked = {r.doc_id: r for r in docs.collect()}
    everything = sorted([*range(len(texts)), 0])
    assert kept["language_id"] == [i for i in everything if i not in (16, 17, 18)]
    assert set(range(12)) | {14, 15} <= set(kept["near_dedup"]) and not {12, 19} & set(kept["near_dedup"])
    assert len(kept["near_dedup"]) == len(set(kept["near_dedup"]))
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {14}
    assert kept["mask_secrets"] == kept["decontamination"] == kept["bpe_coding"]
    assert "[secret]" in masked[15].text and masked[15].n_chars == len(masked[15].text)
    assert masked[3].text == clean[3] and masked[3].n_chars == len(clean[3])
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == kept["bpe_coding"]


def test_columns_that_clash_with_results_pass_through_the_stages(spark, tmp_path):
    extra = ["spans", "score", "lang_pred", "fp", "root", "items", "contaminated", "_text_hash", "n_words"]
    df = documents(spark, [prose(i, 60) for i in range(4)] + ["password = abcdefgh12345678", None])
    df = df.selectExpr("*", *(f"concat('{c}', doc_id) AS {c}" for c in extra))
    spark.createDataFrame([(1, "no such words here")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    docs = df
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    rows = docs.collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 2, 3, 4]
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in extra)
