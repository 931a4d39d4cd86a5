from collections import Counter
from itertools import permutations

from llm_helpers import ODD, SF, docs_df, duck, with_clashes

from geotaxa.llm import filter_audit as fa


def labels_df(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute(rows, labels):
    """rows: (doc_id, text, lang); every order applied filter by filter."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    sets = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows):
            fails.add("E")
        sets.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {s[0] for s in sets}:
        own = [s for s in sets if s[0] == part]
        first = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [s for s in left if f in s[1]]
                left = [s for s in left if f not in s[1]]
                first[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in s[1] for s in own) - len(gone), sum(s[1] == {f} for s in own),
                    sum(s[2] for s in gone), sum(s[3] for s in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[6] = first[row[6]] if isinstance(row[6], str) else row[6]
    return {k: tuple(v) for k, v in out.items()}


def table(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_query_equals_sql(spark):
    df = fa.op11_filter_audit(spark, SF)
    cur = duck().execute(fa.oracle_sql())
    assert [c[0] for c in cur.description] == df.columns
    rows = sorted(map(tuple, df.collect()))
    assert rows == sorted(cur.fetchall()) and len(rows) % 600 == 0


def test_equals_applying_every_order(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(1, long, "en"), (2, long, "en"), (3, long, "de"), (4, long + " #", "en"), (5, "SHOUT " * 30, None),
            (6, None, None), (7, "", "de"), (8, "x " * 5000, "en"), (None, long, "en"), (9, "é" * 100, "fr"),
            (10, "a\x00b c", "fr"), (11, "SHOUT " * 30, "fr")]
    rows += [(i, f"{long} {i % 40}", "en" if i % 3 else "de") for i in range(20, 220)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 1, None), (5, None, 1), (30, 1, 1), (None, 1, 1), (999, 1, 1)]
    full = [(d, t, lang, None) for d, t, lang in rows]
    got = table(fa.audit(fa.combinations(with_clashes(docs_df(spark, full)), labels_df(spark, labels))))
    assert got == brute(rows, labels)


def test_repeated_ids_and_hot_text(spark):
    rows = [(5, "same", "en"), (5, "same", "en"), (5, "other", "en")] + [(10 + i, "same", "en") for i in range(500)]
    full = [(*r, None) for r in rows]
    got = table(fa.audit(fa.combinations(docs_df(spark, full), labels_df(spark, []))))
    assert got == brute(rows, [])
    assert got["en", "EABCD", 1][:2] == (3, 500)


def test_odd_and_empty_tables(spark):
    odd = docs_df(spark, ODD)
    got = table(fa.audit(fa.combinations(odd, labels_df(spark, []))))
    assert got == brute([(r[0], r[1], None) for r in ODD], [])
    assert fa.audit(fa.combinations(docs_df(spark, []), labels_df(spark, [(1, 1, 1)]))).count() == 0


def test_text_of_several_megabytes(spark):
    word = "word" * 20_000                       # one token above 65,536 bytes
    text = " ".join([word] + [f"t{i}" for i in range(400_000)])
    rows = [(1, text, "en"), (2, text, "en"), (3, text + "!", "en")]
    got = table(fa.audit(fa.combinations(docs_df(spark, [(*r, None) for r in rows]), labels_df(spark, []))))
    assert got == brute(rows, [])


def test_plan_has_no_square_and_no_python(spark):
    plan = fa.op11_filter_audit(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan and "Arrow" not in plan
    assert "LeftSemi" in plan
