"""Near-duplicates, decontamination, token counts and personal data against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, near_dedup, pii, shingles, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


def brute_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    sets = {i: brute_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(words, share, rng):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def family_rows(n=90, seed=3):
    rng, rows = random.Random(seed), []
    base = [[f"w{rng.randrange(400)}" for _ in range(120)] for _ in range(4)]
    for i in range(n):
        rows.append((i, edited(base[i % 4], rng.choice([0, 0, 0.01, 0.03, 0.06, 0.2]), rng)))
    return rows


def test_shingle_sets_match_python_sets():
    texts = ["", None, "a", "A b\tc d", "a b c d", "é b\x0bc d e é b c d e", "x " * 50, "one two three four five six"]
    sets = shingles.shingle_sets([None if t is None else t.encode() for t in texts])
    for a, x in zip(texts, sets):
        assert len(x) == len(brute_set(a)) and (np.diff(x.astype(object)) > 0).all()
        for b, y in zip(texts, sets):
            assert len(np.intersect1d(x, y)) == len(brute_set(a) & brute_set(b))


def test_word_hash_does_not_depend_on_the_batch():
    long_word, text = b"y" * 3000, b"alpha beta gamma"
    alone, _ = shingles.word_hashes([text])
    together, counts = shingles.word_hashes([long_word, b" ", text, None])
    assert counts.tolist() == [1, 0, 3, 0] and (together[1:] == alone).all()


@pytest.mark.parametrize("block_docs", [512, 8])
def test_near_duplicates_equal_brute_force(spark, block_docs):
    rows = family_rows()
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), block_docs=block_docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
    assert got == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_near_duplicate_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "same few words"), (5, "Same  few\nwords"), (6, "other"), (7, "a b c d e f"), (7, "a b c d e f"),
            (None, "a b c d e f"), (None, "lonely text without id at all")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as n", "1 as component", "2 as id")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True),
                          (7, 2, 7, True), (None, 2, 7, False), (None, 2, None, False)], key=str)
    kept = near_dedup.keep_one_per_component(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 7]
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(200)) for x in "abcd")
    rows = [(5, a), (9, a), (3, b), (5, b), (None, b), (None, b), (None, c), (None, c), (None, c + " more"), (8, d), (None, d), (7, ""), (None, ""), (None, None), (5, a)]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, rhash int")
    kept = [(r.doc_id, r.text) for r in near_dedup.keep_one_per_component(df).collect()]
    of_c = [t for i, t in kept if i is None and t and t.startswith("c0")]
    assert len(of_c) == 1
    want = [(5, a), (3, b), (None, b), (None, of_c[0]), (8, d), (None, d), (7, ""), (None, ""), (None, None)]
    assert sorted(map(repr, kept)) == sorted(map(repr, want))
    out = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect() if r.n_shingles}
    assert out == {(5, 5, True), (9, 5, False), (3, 3, True), (5, 3, False), (None, 3, False), (None, None, False), (8, 8, True), (None, 8, False)}


def test_bayesian_bounds_keep_the_threshold():
    least = near_dedup.least_matches()
    assert list(least) == [40, 80, 120, 160, 200] and all(m < 0.75 * n for n, m in least.items())
    assert least[200] / 200 > least[40] / 40


def test_leaks_equal_brute_force(spark):
    rng = random.Random(1)
    items = [(i, " ".join(f"q{rng.randrange(60)}" for _ in range(rng.randrange(1, 40)))) for i in range(20)] + [(20, ""), (21, None), (3, "extra text of item three")]
    docs = []
    for i in range(60):
        words = [f"d{rng.randrange(500)}" for _ in range(rng.randrange(0, 3000 if i % 20 == 0 else 200))]
        item = WORD.findall(items[rng.randrange(20)][1])
        at = rng.randrange(len(words) + 1)
        docs.append((i, " ".join(words[:at] + item[:rng.randrange(len(item) + 1)] + words[at:])))
    docs += [(60, None), (61, ""), (62, docs[3][1])]
    df, it = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as item", "'s' as id"), spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in docs:
        for j, q in items:
            x, y = brute_set(t), brute_set(q)
            if y and 100 * len(x & y) >= 75 * len(y):
                want.add((i, j, len(y), len(x & y)))
    for block in (2_000_000, 50):
        assert {tuple(r) for r in decontaminate.find_leaks(df, it, block_shingles=block).collect()} == want
        rest = decontaminate.remove_leaks(df, it, block_shingles=block)
        assert rest.columns == df.columns and {r.doc_id for r in rest.collect()} == {i for i, _ in docs} - {i for i, *_ in want}
    assert decontaminate.find_leaks(df, spark.createDataFrame([], "item_id long, text string")).collect() == []
    assert decontaminate.find_leaks(spark.createDataFrame([], DOCS), it).collect() == []


def token_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "b ", "  ", " ", "▁", "\n", "é", "词", "THE", "<s>", "\t", "wordy "]) for _ in range(rng.randrange(400))) for _ in range(80)]
    return texts + ["", None, " ", "   ", "x" * 3000, "word " * 800, "<unk></s> <0x41>", " lead", "trail ", "\U0001F600 y"]


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_model())
    texts = token_texts()
    df = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], DOCS).selectExpr("*", "5 as n_tokens", "'a' as id")
    want = sorted((len((t or "").encode()), len(sp.encode(t or ""))) for t in texts)
    for chunk, overlap in ((1 << 15, 256), (60, 8)):
        got = token_counts.token_counts(df, chunk_chars=chunk, overlap=overlap).collect()
        assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.token_counts(spark.createDataFrame([], DOCS)).collect() == []


def test_stable_boundaries_need_leading_spaces():
    assert token_counts.spaces_only_lead(["▁a", "▁▁", "b"]) and not token_counts.spaces_only_lead(["a▁b"])


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, said):
    d = re.sub("[^0-9]", "", said)
    if kind == "card":
        total = sum((int(c) * (1 + i % 2)) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in said.split(".")), "phone": 9 <= len(d) <= 15}[kind]


def brute_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


HARD = ["a@b.c%d@e.f.g x@y a.b@c.d,e@f.g", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.0003.0255 1.2.3.256", "0000000000000 4111 1111 1111 1111",
        "+1 (705) 555-1710 +49.30.123456 +1-2 +++1234567890 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é词\U0001F600a@b.co \x01x@y.zz\x01 5 6", "", None,
        "9" * 5000, "a" * 3000 + "@", "1 " * 3000, "x@y.z " * 2500, "+1(" * 400, "12 " * 20 + "a@b.c\n" * 5, "jo(at)host(dot)com"]


def test_base_spans_equal_brute_force_and_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(HARD)], DOCS)).selectExpr("*", "1 as n_email", "2 as start")
    got = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    for r in docs.collect():
        want, out = brute_spans(r.text), got[r.doc_id]
        assert out.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(out.spans.split(","))
        assert out.n_email == want.count("email:") and out.n_ip == want.count("ip:") and out.n_card == want.count("card:") and out.n_phone == want.count("phone:")


def test_numbers_beside_other_numbers_are_found(spark):
    rows = [(i, f"call 555-{i % 900 + 100}-{i + 1000} now, part {i * 7919 % 10**7:07d} of lot {i}-{i % 7}-{i * 31 % 999:03d}") for i in range(400)]
    fused = [(1000, "call 555-123-4567 555-222-3333"), (1001, "call 555-123-4567 24/7"), (1002, "call 555-123-4567. 2 items")]
    got = {r.doc_id: r.spans.split(",") for r in pii.find_pii(spark.createDataFrame(rows + fused, DOCS)).where("doc_id >= 1000").collect()}
    assert got == {1000: ["phone:5:17", "phone:18:30"], 1001: ["phone:5:17"], 1002: ["phone:5:17"]}


def test_redaction_keeps_columns_and_clean_texts(spark):
    rows = [(1, "write to a.b@c.de or 10.0.0.1 now", "x"), (2, "nothing here", None), (3, None, "y"), (None, "", "z"), (4, "a@b.c" * 2, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __extra string")
    out = pii.redact(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "write to [EMAIL] or [IP] now", 2: "nothing here", 3: None, None: "", 4: "[EMAIL]@b.c"}
    assert pii.find_pii(spark.createDataFrame([], DOCS)).collect() == []


def test_long_chains_do_not_overflow(spark):
    n = 100_000
    texts = ["x@" + "a." * n + "a", "x(at)" + "a(dot)" * n + "a", "x@" + "a [dot] " * n + "a", "a" * n + "@b.c", "a@b" + ".c" * n + "@" + "d." * n, "1 " * n, "1" * n,
             "1-" * n + "1", "+1" + "(2) " * n + "3", "+" * n + "1", "1." * n + "1", "555-123-4567 " * n, "0" * n + ".1.1.1", "x@y.z" * n]
    patterns = [*pii.PATTERNS.values(), pii.LOOSE_NUMBER, pii.LOOSE_ADDRESS, *pii.FORMATS.values()]
    counted = spark.createDataFrame([(t,) for t in texts], "text string").select(*[F.regexp_count("text", F.lit(p)) for p in patterns]).collect()
    assert [r[5] for r in counted[:3]] == [1, 1, 1] and [r[0] for r in counted] == [1, 0, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, n // 2]
    clean = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(list(enumerate(texts[:7])), DOCS)).collect()}
    assert clean[0] == "[EMAIL]" and clean[3] == "[EMAIL]"


def test_null_item_ids_in_any_order(spark):
    text = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, "clean " * 40)], DOCS)
    for kind in ("long", "string", "decimal(20,0)"):
        for order in ((None, 5), (5, None), (None, None)):
            items = spark.createDataFrame([(i, text if i is None else text + " more") for i in order], "item_id long, text string")
            items = items.coalesce(1).selectExpr(f"cast(item_id as {kind}) as item_id", "text")
            got = {None if r.item_id is None else int(r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
            assert got == set(order) and [r.doc_id for r in decontaminate.remove_leaks(docs, items).collect()] == [2]
