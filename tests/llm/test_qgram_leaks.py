import random

from llm_helpers import ODD, SF, docs_df, duck, with_clashes

from geotaxa.llm import qgram_leaks as ql


def distance(pattern, text):
    """Smallest edit distance of ``pattern`` to any stretch of ``text`` (Sellers)."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def plain(text):
    import numpy as np
    raw = np.frombuffer(text.encode(), np.uint8)
    return ql.normal(raw, np.array([0, len(raw)]))[0].tobytes().strip()


def passages(item):
    n = plain(item)
    if len(n) < ql.Q:
        return []
    if len(n) <= ql.PASSAGE:
        return [n]
    starts = sorted({*range(0, len(n) - ql.PASSAGE, ql.PASSAGE // 2), len(n) - ql.PASSAGE})
    return [n[s:s + ql.PASSAGE] for s in starts]


def budget(passage):
    return min(int(ql.EDITS * len(passage)), (len(passage) - ql.Q) // ql.Q)


def found(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_whole_items_in_the_table_are_found(spark):
    rows = ql.op9_qgram_leaks(spark, SF).collect()
    docs = dict(duck().execute("select doc_id, coalesce(text, '') from documents").fetchall())
    items = dict(duck().execute("select item_id, text from benchmark").fetchall())
    want = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert want and want <= got
    for r in rows:
        if (r["doc_id"], r["item_id"]) in want:
            at = docs[r["doc_id"]].index(items[r["item_id"]])
            assert r["edits"] == 0 and r["start"] <= at and r["end"] >= at + len(items[r["item_id"]].rstrip(". \n"))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghiéo") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_edited_passages_equal_brute_force(spark):
    rng = random.Random(17)
    items = [(i, prose(rng, n)) for i, n in enumerate((6, 12, 20, 30, 60))] + [(90, "short"), (91, None), (92, "")]
    docs = []
    for d in range(60):
        base = list(rng.choice([t for i, t in items[:5]]))
        for _ in range(rng.choice([0, 1, 3, 6, 9, 12, 25, 60])):
            k = rng.randrange(len(base))
            base[k:k + 1] = rng.choice([[], [rng.choice("xyz")], [base[k], "q"]])
        docs.append((d, f"{prose(rng, rng.randint(0, 30))} {''.join(base).upper()}; {prose(rng, 8)}"))
    docs += [(100, items[4][1][:400]), (101, items[4][1][60:330]), (102, prose(rng, 300))]
    got = found(ql.find_leaks(with_clashes(docs_df(spark, docs)), spark.createDataFrame(items, "item_id long, text string")))
    want = set()
    for d, t in docs:
        body = plain(t)
        for i, b in items:
            if any(distance(p, body) <= budget(p) for p in passages(b or "")):
                want.add((d, i))
    assert got == want and len(want) > 15 and (102, 4) not in got


def test_blocks_of_the_benchmark_do_not_change_the_result(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(map(tuple, ql.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(ql, "BLOCK", 3000)
    assert len(ql.benchmark_blocks(bench)) > 2
    assert sorted(map(tuple, ql.find_leaks(docs, bench).collect())) == one
    leaking = {r[0] for r in one}
    kept = {r["doc_id"] for r in ql.drop_leaks(docs, bench).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - leaking


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "no id at all, same text here, and more"), (1, "no id at all, same text here, and more")],
                                  "item_id long, text string")
    docs = with_clashes(docs_df(spark, ODD + [(20, "No ID at all; same TEXT here and more!")] * 2))
    assert [tuple(r)[:2] for r in ql.find_leaks(docs, bench).collect()] == [(20, 1)] * 4
    kept = ql.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert ql.find_leaks(docs, bench.limit(0)).count() == 0
    assert ql.drop_leaks(docs, bench.limit(0)).count() == len(ODD) + 2
    assert ql.find_leaks(docs_df(spark, []), bench).count() == 0


def test_every_verbatim_excerpt_of_a_run_is_found(spark):
    rng = random.Random(23)
    items = [(i, prose(rng, 45)) for i in range(12)] + [(50, "Same opening words of two items, long enough to be a run of bytes: " + prose(rng, 9))]
    items.append((51, items[-1][1][:70] + prose(rng, 20)))
    docs, want = [], set()
    for d in range(150):
        i, text = rng.choice(items[:12])
        body, n = plain(text), rng.choice([ql.RUN, ql.RUN + 5, 80, 100, 115, 140])
        while True:                                    # a random excerpt of whole characters
            a = rng.randrange(len(body) - n + 1)
            try:
                part = body[a:a + n].decode().strip()
            except UnicodeDecodeError:
                continue
            if len(part.encode()) == n:
                break
        docs.append((d, f"{prose(rng, rng.randint(0, 40))} QZ{part.upper().replace('É', 'é')}QZ {prose(rng, 20)}"))
        want.add((d, i))
    docs.append((200, items[-1][1][:70] + "?"))
    want |= {(200, 50), (200, 51)}
    # Less than a run, and a run over two rows, are none.
    docs += [(300, plain(items[0][1])[:ql.RUN - 4].decode("utf-8", "ignore"))]
    half = plain(items[1][1])
    docs += [(400, half[40:80].decode("utf-8", "ignore")), (401, half[80:120].decode("utf-8", "ignore"))]
    rows = ql.find_leaks(docs_df(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    text = dict(docs)
    for r in rows:
        assert r["edits"] == 0
        if r["doc_id"] < 150:
            inside = text[r["doc_id"]].split("QZ")[1].strip()
            assert inside in text[r["doc_id"]][r["start"]:r["end"]]


def test_short_items_are_found_verbatim_on_word_bounds(spark):
    rng = random.Random(31)
    items = [(1, "ab cde f"), (2, "ÉCLAIR"), (3, "x1"), (4, "x1"), (4, "x1"), (5, "?!"), (6, "Ab,  Cde... F!"), (7, "ninebytes")]
    words = ["ab", "cde", "f", "éclair", "Éclair", "x1", "x12", "ninebytes", "AB", "Cde", "abc", "q"]
    docs = [(d, rng.choice(["", " ", "--"]) + rng.choice([" ", "; ", "\n"]).join(rng.choices(words, k=rng.randint(0, 7)))
             + rng.choice(["", ".", "  "])) for d in range(200)]
    docs += [(900, None), (901, ""), (902, "ab"), (903, "cde f"), (904, "x1"), (905, "x1x1"), (906, "x AB cde F."), (907, "ab cde fx")]
    got = sorted(tuple(r)[:2] for r in ql.find_leaks(with_clashes(docs_df(spark, docs)),
                                                     spark.createDataFrame(items, "item_id long, text string")).collect())
    want = sorted((d, i) for d, t in docs for i, b in items if plain(b) and b" " + plain(b) + b" " in b" " + plain(t or "") + b" ")
    assert got == want and {i for _, i in want} == {1, 2, 3, 4, 6, 7}
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = {r["doc_id"] for r in ql.drop_leaks(docs_df(spark, docs), bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_a_repeated_item_is_indexed_once(spark):
    text = "a passage that is long enough for q-grams"
    bench = spark.createDataFrame([(1, text)] * 500 + [(None, text)], "item_id long, text string")
    blocks = ql.benchmark_blocks(bench)
    assert len(blocks) == 1 and len(ql.index_of(blocks[0]).items) == 2
    assert ql.find_leaks(docs_df(spark, [(3, "x " + text + " y")]), bench).count() == 501
