"""HTML extraction, URL filter, mixing, top-k, chat formatting, toxicity and the pipeline."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from cohortlens.llm import chat_format, cover_tree, html_extract, mixing, near_dedup, pii, toxicity, url_filter
from cohortlens.llm.queries import ORACLE_SQL, QUERIES
from cohortlens.sources.tables import read_table
from test_text_operators import brute_components, brute_set

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def same_as_duckdb(sql, got, tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toArrow()) if hasattr(rows, "toArrow") else con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{rows}')")
    rel = con.sql(sql)
    cols = sorted(got.columns)
    at = [rel.columns.index(c) for c in cols]
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    want = sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    return sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr) == want and sorted(rel.columns) == cols


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert same_as_duckdb(ORACLE_SQL[name], QUERIES[name](spark, SF), {t: f"{SF}/{t}.parquet" for t in TABLES})


def page(body, extra=""):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href='/x'>Home</a></nav>{body}{extra}<footer>&copy; x</footer></body></html>"


def test_html_main_text(spark):
    rows = [(1, "http://a.com/1", page("<article><h1>Head &amp; co</h1><p><b>First\n  par<br>next<p>Second</article>")),
            (2, "http://a.com/2", page("<main><div class='ad'>Buy</div><p>Kept&nbsp;text</p><div id='comments'><p>me too</p></div></main>")),
            (3, None, None), (4, "x", ""), (5, "http://b.com", "<p>cut off <b>mark"), (6, "http://b.com", "no markup &lt;here&gt;"),
            (7, "http://b.com", "<div>" * 1000 + "deep" + "</div>" * 1000), (8, "http://b.com", "<article><script>never closed <p>x")]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as k", "2 as host")).collect()}
    assert got == {1: "Head & co First par next Second", 2: "Kept text", 3: "", 4: "", 5: "cut off mark", 6: "no markup <here>", 7: "deep", 8: ""}
    assert html_extract.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_wrapper_drops_repeated_slots_and_keeps_varying_ones(spark):
    rows = [(i, f"http://h.org/{i}", f"<html><body><div class=top>Our motto</div><div class=text><p>Story {i} tells of {i * 7} things that matter</p></div><div class=low>Call us</div></body></html>")
            for i in range(12)] + [(99, "http://h.org/99", "<html><body><div class=text><p>Another one</p></div></body></html>")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3][0] == "Story 3 tells of 21 things that matter" and got[99] == ("Another one", 11)


def test_copies_of_an_article_stay_content(spark):
    rows = [(i, "http://h.org/", page("<article><p>The same words again, many times over on this host</p></article>")) for i in range(30)]
    assert {r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"The same words again, many times over on this host"}


def test_copies_do_not_make_a_template(spark):
    words = "The same long words again, many times over on this host. " * 9
    copies = [(i, f"http://h.org/{i}", page(f"<article><h1>Headline</h1><p>{words}</p><div class=box>Note</div></article>")) for i in range(30)]
    twice = [(100 + 2 * i + k, f"http://t.org/{i}/{k}", f"<html><body><h1>Head {i}</h1><p>Lead {i} is short</p><div class=a>{i} {words}</div><div class=b>{words} {i}</div></body></html>")
             for i in range(10) for k in range(2)]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(copies + twice, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Headline {words}Note" for i in range(30))
    assert all(got[100 + 2 * i + k].startswith(f"Head {i} Lead {i} is short {i} The") for i in range(10) for k in range(2))


def test_names_inside_an_article(spark):
    body = ("<article><section id='search-methods'><p>Found</p></section><h2 id='related-work'>Related</h2><section id='legal'><p>Law</p></section>"
            "<div class='share-price'>Price</div><p class='meta-analysis'>Meta</p><h2 id='comments'>Views</h2><div class='share'>Tweet</div></article>")
    rows = [(1, "http://a.com/1", page(body))] + [
        (i, f"http://b.com/{i}", page(f"<article><p>Story {i} tells of {i * 7} things that matter</p><div class='related-posts'>See also {i % 2}</div><div class='x'>Part {i % 2}</div></article>"))
        for i in range(10, 22)]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "Found Related Law Price Meta Views"
    assert "See also" not in got[11] and got[11].endswith("Part 1")


def test_wrappers_named_by_a_part_of_a_class_keep_their_article():
    read = lambda html: html_extract.read_text(html, "")
    for name in ("page has-sidebar", "no-sidebar", "overflow-hidden", "search-results", "layout-menu-left", "social-science", "has-comments"):
        assert read(f"<div class='{name}'><nav>n</nav><article><h1>t</h1><p>long text</p></article></div><p>x</p>") == "t long text", name
        assert read(f"<body><form><div class='{name}'><article><p>long text</p><form>f</form></article></div></form></body>") == "long text", name
    assert read("<div class='has-sidebar'><h1>t</h1><p>a</p><p>b</p><div class='sidebar'><p>s</p></div></div>") == "a b"
    assert read("<form><p>Name</p><input></form>") == ""
    # cards of other articles don't replace the page's own text
    assert read("<p>the page's own long text</p><div class='related-posts'><article>card</article></div>") == "the page's own long text"
    assert read("<div class='comments'><article class='comment'>a long reader comment</article></div><p>own</p>") == "own"


def test_parts_of_an_article_that_are_not_its_text():
    read = lambda part: html_extract.read_text(f"<article><p>a</p>{part}<p>b</p></article>", "")
    for part in ("<div class='post-comments'>c</div>", "<div class='comments-area'>c</div>", "<div class='newsletter-signup'>c</div>", "<div class='ad-slot'>c</div>",
                 "<div class='cookie-notice'>c</div>", "<div id='respond'>c</div>", "<p hidden>c</p>", "<p hidden/>c</p>", "<p HIDDEN class=x>c</p>",
                 "<p style='color:red; display: none'>c</p>", "<p style=\"visibility:hidden\">c</p>"):
        assert read(part) == "a b", part
    for part in ("<section id='search-methods'>c</section>", "<p class='meta-analysis'>c</p>", "<div class='share-price'>c</div>", "<h2 id='related-work'>c</h2>",
                 "<div class='section-header'>c</div>", "<p title='hidden'>c</p>", "<p style='display:block'>c</p>", "<p data-hidden>c</p>"):
        assert read(part) == "a c b", part


def test_html_after_a_deep_nest():
    nest = "<div>" * 300 + "deep<script>x</script><nav>menu</nav>" + "</div>" * 300
    html = f"<html><body><div id=page><article>{nest}<p>after</p></article></div><p>outside</p></body></html>"
    assert html_extract.read_text(html, "") == "deep after"


def test_tree_match_aligns_in_order():
    a = [[-1, ""], [0, "body"], [1, "nav"], [1, "p"], [1, "footer"]]
    b = [[-1, ""], [0, "body"], [1, "p"], [1, "footer"]]
    assert html_extract.tree_match(a, b) == {0: 0, 1: 1, 3: 2, 4: 3}


def test_url_verdicts(spark):
    urls = [None, "", "no scheme casino", "http://WWW.Example.com/en/x", "http://example.com/en/", "http://example.com", "http://notexample.com/en/", "https://a.net/es/1?x=casino",
            "https://a.net/de/", "https://free-bets.org/", "https://free.org/freebets", "http://x.org/porn?q", "http://x.org/porno-free", "http://x.org:80/spamfarm", "http://é.org/SPAM#a", "a://b://c/d"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "0 as weight", "1 as id")
    out = url_filter.judge_urls(rows)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got[0] == ("", "", None, "allow") and got[2] == ("", "", None, "block") and got[3] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[4][2:] == ("example.com/en/", "block") and got[5][2:] == (None, "allow") and got[6][2:] == ("com/", "allow") and got[7][2:] == ("net/es/", "block")
    assert [got[k][3] for k in range(8, 15)] == ["allow", "block", "allow", "block", "block", "allow", "block"]
    assert same_as_duckdb(ORACLE_SQL["op2_url_filter"], out, {"pages": rows.drop("weight", "id")})


def test_longest_rule_may_have_the_longer_path():
    rules = url_filter.index_rules([("com", "/long/path/", "allow"), ("a.com", "/", "block")])
    assert url_filter.fitting_rule("a.com", "/long/path/x", rules) == ("com/long/path/", "allow")


def mixing_rows():
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 300 if i % 50 else 6000), rng.choice(["a"] * 6 + ["b", "c", "d", "e", None])) for i in range(400)]
    return rows + [(400, None, "a"), (401, "", "f"), (402, " \n", "f"), (3, "again here", "a"), (None, "x y", "b"), (None, "z", "b")]


def test_mixing_targets_and_sql(spark):
    docs = spark.createDataFrame(mixing_rows(), "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as epochs", "3 as last")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 200, 3)] + [(3, None), (6, 1), (None, 1), (7, None)], "doc_id long, quality int")
    out = mixing.mix(docs, labels)
    rows = out.collect()
    assert len(rows) == len(mixing_rows()) and sum(r.taken for r in rows) > 0
    assert same_as_duckdb(mixing.oracle_sql(), out, {"documents": docs.select("doc_id", "text", "source"), "labels": labels})
    by_target = {}
    for r in rows:
        assert r.taken <= 3 * r.size and r.target <= 3 * r.source_size
        by_target.setdefault((r.source_size, r.target), []).append(r)
    total = sum(s for s, _ in by_target)
    assert math.isclose(sum(t for _, t in by_target), total)
    for (_, target), group in by_target.items():
        assert abs(sum(r.taken for r in group) - target) <= max(r.size for r in group)
    mixed = mixing.mixed_documents(docs, labels)
    assert set(docs.columns) - {"epochs", "last"} <= set(mixed.columns)
    assert sorted((r.doc_id or -1, r.repeats * (len((r.text or "").split()))) for r in mixed.collect() if (r.text or "").split()) == sorted(
        (r.doc_id or -1, r.taken) for r in rows if r.taken)


def test_mixing_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix(one).collect()] == [(1, 0, 0, 0.0, 0)]


def brute_top(rows, k, every):
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 60])
def test_top_k_equals_brute_force(spark, block):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.1, (60, 6)) for c in (-1, 0, 1)] + [np.full((40, 6), 0.5)]).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000, None), (1001, [1.0, None]), (1020, [float("nan")] * 6), (1040, [float("inf")] * 6), (None, [1.0] * 6), (1060, [2.0, 1.0]), (1061, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as block", "2 as id")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(df, block=block).collect())
    assert got == brute_top(rows, 20, 20)


def test_top_k_of_few_and_huge_vectors(spark):
    rows = [(0, [3e8, 1e8]), (20, [3e8, 1e8]), (5, [-3e8, 2.0]), (6, [3e8, 1e8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(df).collect()) == [
        (q, n, i, max(min(s, 2**63 - 1), -(2**63))) for q, n, i, s in brute_top(rows, 20, 20)]
    assert cover_tree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_cover_tree_covers_and_search_prunes():
    rng = np.random.default_rng(1)
    x = np.floor(64 * np.concatenate([rng.normal(c, 0.02, (400, 8)) for c in (-2, 0, 2)]))
    tree = cover_tree.CoverTree(x)
    for centre, radius, members in zip(tree.centre, tree.radius, tree.members):
        assert np.sqrt(((x[members] - centre) ** 2).sum(axis=1)).max() <= radius + 1e-9
    leaves = np.concatenate([m for m, leaf in zip(tree.members, tree.is_leaf) if leaf])
    assert sorted(leaves) == list(range(len(x)))
    search = cover_tree.Search(x[::20], np.arange(0, 1200, 20), x, np.arange(1200), np.full(60, -np.inf), 5)
    assert search.scored < 60 * 1200


def test_chats_collapse_to_maximal(spark):
    log = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", "more"), (3, 0, "user", "hi"),
           (4, 5, "user", "hi"), (4, 9, "assistant", "yo"), (4, 10, "user", "more"), (5, 0, None, None), (6, None, "user", "x <|im_end|>"), (6, 0, "user", "y"),
           (7, 0, "user", "b"), (7, 0, "user", "a"), (7, 0, "user", "a"), (None, 0, "user", "no id"), (8, 0, "assistant", "hi")]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pos", "2 as part")
    out = chat_format.format_chats(df)
    got = {r.conv_id: (r.part, r.n_turns, r.text) for r in out.collect()}
    assert set(got) == {2, 5, 6, 7, 8, None} and got[2][1] == 3 and got[7][1] == 2
    assert got[6][2] == "<|im_start|>user\nx <¦im_end|><|im_end|>\n<|im_start|>user\ny<|im_end|>\n"
    assert same_as_duckdb(chat_format.ORACLE_SQL, out, {"conversations": df.drop("pos", "part")})
    parts = chat_format.format_chats(df, part_turns=2).where("conv_id = 2").orderBy("part").collect()
    assert [p.n_turns for p in parts] == [2, 1] and "".join(p.text for p in parts) == got[2][2]
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def toxic_rows(n=600, seed=4):
    rng, docs, labels = random.Random(seed), [], []
    stems = ["ba", "do", "ki", "lu", "me", "ro", "sa", "tu"]
    for i in range(n):
        words = ["".join(rng.choice(stems) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 200))]
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), "vraxx" + rng.choice(stems))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_rows()
    df = spark.createDataFrame(docs + [(9001, None), (9002, ""), (None, "kilu"), (3, docs[3][1])], "doc_id long, text string").selectExpr("*", "1 as score", "'g' as group")
    marks = spark.createDataFrame(labels + [(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.score(df, marks).collect()
    assert len(rows) == len(docs) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    truth = dict(labels)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    kept = toxicity.drop_toxic(df, marks)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in rows if not r.predicted)


def exact_ratios(docs, groups, model):
    """Every corpus gram's log-likelihood ratio under the training groups of a model, by dictionaries."""
    seen, by_class = Counter(), (Counter(), Counter())
    for (_, text), group in zip(docs, groups):
        found = toxicity.grams(toxicity.words_of(text.encode()))[0].tolist()
        seen.update(found)
        if group in model:
            by_class[group % 2].update(found)
    tails = Counter(g & (1 << 48) - 1 for g in seen)
    n4, t4, n1 = Counter(), Counter(g >> 8 for g in tails), Counter()
    for g, left in tails.items():
        n4[g >> 8] += left
        n1[g & 255] += left
    shared = lambda g: (max(tails[g] - 0.75, 0) + 0.75 * t4[g >> 8] * n1[g & 255] / len(seen)) / n4[g >> 8]
    probs = []
    for counts in by_class:
        n, t = Counter(), Counter(g >> 8 for g in counts)
        for g, k in counts.items():
            n[g >> 8] += k
        probs.append({g: (max(counts[g] - 0.75, 0) + 0.75 * t[g >> 8] * shared(g & (1 << 48) - 1)) / n[g >> 8] if n[g >> 8] else shared(g & (1 << 48) - 1) for g in seen})
    return {g: math.log(probs[0][g]) - math.log(probs[1][g]) for g in seen}


def exact_features(text, ratio):
    values = [sum(ratio[g] for g in toxicity.grams([w])[0].tolist()) / (len(w) + 1) ** 0.5 for w in toxicity.words_of(text.encode())]
    return [max(values), sum(sorted(values)[-5:]), sum(values) / len(values)] if values else [0.0] * 3


def test_toxicity_scores_equal_exact_tables(spark):
    """60,000 grams, some hundred of which would share one of 2**22 slots."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 12)))
    docs = [(i, " ".join([word() for _ in range(40)] + ["grubl" + word()[:3]] * (i % 4 == 0))) for i in range(200)]
    rest = [zlib.crc32(str(i).encode()) % 3 for i, _ in docs]
    groups = [None if r == 1 else int(i % 4 != 0) + r for (i, _), r in zip(docs, rest)]
    tables = {k: exact_ratios(docs, groups, m) for k, m in (("all", range(4)), (0, (2, 3)), (2, (0, 1)))}
    crossed = [(*exact_features(t, tables[r]), 1 - g % 2) for (_, t), r, g in zip(docs, rest, groups) if g is not None]
    bias, weights = toxicity.fitted(spark.createDataFrame(crossed, "strongest double, top double, mean double, y int"))
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"),
                                                     spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs], "doc_id long, toxic int")).collect()}
    margin = lambda s: math.log(s / (1 - s))
    for i, text in docs:
        want = bias + sum(w * f for w, f in zip(weights, exact_features(text, tables["all"])))
        assert abs(want) > 30 or abs(margin(got[i]) - want) < 1e-4


def test_toxicity_families_share_their_grams(spark):
    """One row per gram and family, however many partitions the input has; the same counts and features for any size of packs."""
    docs, _ = toxic_rows(120)
    rows = spark.createDataFrame([(i, text, None if i % 5 == 4 else i % 5) for i, text in docs], "id long, text string, group int").repartition(24)
    few, many = toxicity.packed(toxicity.in_tasks(rows, 0)), toxicity.packed(rows, pack_bytes=1500, most_grams=200)
    want = Counter()
    for i, text in docs:
        for w, n in Counter(toxicity.words_of(text.encode())).items():
            for g in set(gs := toxicity.grams([w])[0].tolist()):
                want[g] += 0
                want[g, i % 5] += n * gs.count(g) * (i % 5 < 4)
    features = []
    for packs, families in ((few, range(1, spark.sparkContext.defaultParallelism + 1)), (many, range(25, 121))):
        counts = toxicity.gram_counts(packs)
        got = {r[0]: tuple(r[1:]) for r in counts.collect()}
        assert got == {g: tuple(want[g, k] for k in range(4)) for g in want if not isinstance(g, tuple)}
        by_gram = toxicity.family_ratios(packs, toxicity.ratios(counts))
        assert by_gram.select("family").distinct().count() in families and by_gram.groupBy("family", "gram").count().where("count > 1").count() == 0
        features.append({r.id: tuple(r)[1:] for r in toxicity.with_features(packs, toxicity.ratios(counts), "bigint").collect()})
    assert features[0].keys() == features[1].keys() == dict(docs).keys()
    assert all(a == b or abs(a - b) < 1e-9 for i in features[0] for a, b in zip(features[0][i], features[1][i]))


def test_toxicity_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), none).collect() == []


def test_pipeline_equals_brute_force(spark):
    """Stage by stage over sf0.001: the decisions of run() against plain Python and DuckDB."""
    docs = read_table(spark, SF, "documents")
    toxic = {r.doc_id for r in toxicity.score(docs, read_table(spark, SF, "labels")).where("predicted = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id not in toxic}
    comps = brute_components([(i, r.text) for i, r in rows.items()])
    rows = {i: r for i, r in rows.items() if comps[i][1] == i}
    items = [s for s in (brute_set(r.text) for r in read_table(spark, SF, "benchmark").collect()) if s]
    rows = {i: r for i, r in rows.items() if not any(100 * len(brute_set(r.text) & s) >= 75 * len(s) for s in items)}
    left = spark.createDataFrame(list(rows.values()), docs.schema)
    spans = {r.doc_id: r.spans for r in pii.find_pii(left).collect()}
    clean = []
    for i, r in rows.items():
        text, end = r.text, None
        for s in reversed([s.split(":") for s in spans[i].split(",") if s]):
            a, b = int(s[1]), int(s[2])
            text, end = text[:a] + f"[{s[0].upper()}]" + text[b:], a
        clean.append((i, text, r.lang, r.source, r.n_chars))
    left = spark.createDataFrame(clean, docs.schema)
    con = duckdb.connect()
    con.register("documents", left.toArrow())
    con.execute(f"CREATE VIEW labels AS SELECT * FROM read_parquet('{SF}/labels.parquet')")
    taken = {r[0]: (r[1], r[2]) for r in con.sql(f"SELECT doc_id, taken, size FROM ({mixing.oracle_sql()})").fetchall()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert {i for i, (t, _) in taken.items() if t} == {i for i, r in got.items() if (r.text or "").split()}
    for i, text, lang, source, n in clean:
        if i in got and taken[i][1]:
            assert (got[i].text, got[i].source, got[i].repeats * taken[i][1]) == (text, source, taken[i][0])
    assert len(got) < docs.count() and set(docs.columns) < set(corpus_pipeline.run(spark, SF).columns)


def test_stages_keep_the_columns(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.names == docs.schema.names, name
    assert near_dedup.keep_one_per_component(docs).count() == 0


def test_clustered_table_scores_under_half_of_the_pairs():
    rng = np.random.default_rng(8)
    x = np.floor(64 * (rng.normal(size=(30, 16)) * 2)[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 16)))
    search = cover_tree.Search(x[::20], np.arange(0, 6000, 20), x, np.arange(6000), np.full(300, -np.inf), 10)
    assert search.scored < 0.5 * 300 * 6000
    full = x[::20] @ x.T
    for q in range(300):
        full[q, 20 * q] = -np.inf
        order = np.lexsort((np.arange(6000), -full[q]))[:10]
        assert search.found[q].tolist() == order.tolist() and search.best[q].tolist() == full[q, order].tolist()


def test_repeated_query_and_candidate_ids(spark):
    rows = [(0, [3.0, 1.0]), (0, [1.0, 2.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 5.0]), (2, [0.5, 0.5])]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()]
    q = (64, 128)                                                      # the smaller of the two query vectors
    want = sorted(((-(q[0] * int(64 * a) + q[1] * int(64 * b)), i) for i, (a, b) in rows if i))
    assert got == [(0, k + 1, i, -s) for k, (s, i) in enumerate(want)]
