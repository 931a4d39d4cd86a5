from llm_helpers import ODD, SF, docs_df, duck, rows_by_id, with_clashes

from geotaxa.llm import license_scan as ls


def test_query_equals_sql(spark):
    df = ls.op8_license_scan(spark, SF)
    cur = duck().execute(ls.oracle_sql())
    assert [c[0] for c in cur.description] == df.columns
    assert sorted(map(tuple, df.collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_places_blocks_and_thresholds(spark):
    rows = [
        (20, "MIT-license, mit  LICENSE! then CC/by and apache\nlicense"),
        (21, "summit license; mit licenses; gnu general publicé license"),
        (22, "a\nPermission is hereby granted, free of charge,\nto any person obtaining a copy of\nthis software and associated docs"),
        (23, "permission is hereby granted to any person"),
        (24, "x " * 500 + "Licensed under the Apache License, Version 2.0.\n" + "y " * 500),
        (25, "free of charge\n" * 3 + "to any person obtaining a copy of\n\n\n\nthis software and associated documentation files"),
        (26, "# Permission is hereby granted, free of charge,\n#\n# to any person obtaining a copy of\n#\n\n# this software and associated documentation files"),
        (27, "MIT LICENSE \u212Ait mit l\u0130cense end"),
        (28, "\n#\n * \n"),
    ]
    got = rows_by_id(ls.scan_licenses(with_clashes(docs_df(spark, rows))))
    assert tuple(got[20])[1:7] == (10, 4, 0, 8, "apache,cc-by,mit", "apache,cc-by,mit")
    assert got[21]["n_base"] == 0 and got[21]["first_word"] is None and got[21]["labels"] == ""
    assert got[22]["labels"] == "mit" and 0.8 <= got[22]["score"] < 1
    assert got[23]["labels"] == "" and got[23]["score"] == 0
    assert got[24]["labels"] == "apache,apache-2.0" and got[24]["first_word"] == 503 and got[24]["score"] == 1
    assert got[25]["labels"] == ""           # 15 of 19 tokens in three lines with words
    assert got[26]["labels"] == "mit" and got[26]["score"] >= 0.8   # blank comment lines do not cut a block
    assert got[27]["n_base"] == 1 and got[27]["n_words"] == 6       # only A-Z is lower-cased
    assert got[28]["labels"] == "" and got[28]["n_words"] == 0


def test_odd_rows(spark):
    out = ls.scan_licenses(with_clashes(docs_df(spark, ODD))).collect()
    assert len(out) == len(ODD)
    by_id = {r["doc_id"]: r for r in out}
    assert tuple(by_id[1])[1:] == (0, 0, None, None, "", "", 0.0)
    assert by_id[5]["n_words"] == 5 and by_id[6]["n_words"] == 4000
    assert ls.scan_licenses(docs_df(spark, [])).count() == 0
    assert ls.scan_licenses(docs_df(spark, [(1, "mit license")]), templates={}).first()["labels"] == "mit"


def test_edge_texts_equal_sql(spark):
    """The query and its SQL on texts where letters, blank lines and lengths are odd."""
    import duckdb
    rows = [(1, "MIT LICENSE \u212Ait mit l\u0130cense"), (2, "#\n" * 5 + "released under\n//\nthe mit\n\n license"), (3, None), (4, ""),
            (5, "\n\n"), (6, "word " * 500_000 + "Apache License"), (7, "w" * 70_000 + " cc by"), (None, "mit license")]
    df = docs_df(spark, rows)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.execute(ls.oracle_sql()).fetchall()
    assert sorted(map(tuple, ls.scan_licenses(df).collect()), key=str) == sorted(want, key=str)
