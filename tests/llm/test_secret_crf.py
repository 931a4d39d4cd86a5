import hashlib
import itertools
import re

import numpy as np
from llm_helpers import ODD, SF, docs_df, rows_by_id, texts, with_clashes

from geotaxa.llm import secret_crf as sc

ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def check(row, text):
    want = brute(text)
    words = [f"{sc.KINDS[k]}:{a}:{b}" for a, k, b in want]
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(sum(k == x for _, k, _ in want) for x in range(3))
    assert row["base_sha256"] == hashlib.sha256(",".join(words).encode()).hexdigest()
    spans = row["spans"].split(",") if row["spans"] else []
    assert set(words) <= set(spans) and [s for s in spans if not s.startswith("crf")] == words
    assert row["n_added"] == len(spans) - len(words)


def test_query_keeps_every_pattern_match(spark):
    docs = texts()
    for d, r in rows_by_id(sc.op10_secret_scan(spark, SF)).items():
        check(r, docs[d])


def test_patterns_equal_regular_expressions(spark):
    rng = np.random.default_rng(6)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "'", '"', " ", "=", ":", "\n", "é", "ſ", "AKIA",
             "ABCD1234", "0a1b2c", "deadbeef" * 3, "xyz-9", "abcdef", "K", "漢", "\t"]
    rows = [(i, "".join(rng.choice(parts, rng.integers(1, 60)))) for i in range(400)]
    rows += [(500, "token=token=abcdef1 secret:abc password = 'x" + "y" * 30), (501, "a" * 24 + "g" + "f" * 23), (502, "AKIA" * 6)]
    model = sc.Model(sc.NOTHING.weights, sc.NOTHING.moves)
    got = rows_by_id(sc.scan_secrets(with_clashes(docs_df(spark, rows)), model))
    for d, t in rows:
        check(got[d], t)
        assert got[d]["n_added"] == 0


def test_learned_spans_reach_beyond_the_patterns(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("aeioustrn"), rng.integers(2, 8)))
    hexes = lambda: "".join(rng.choice(list("0123456789abcdef"), 40))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f'{prose(40)} token = "{hexes()}" {prose(30)}') for i in range(120)]
    rows += [(1000 + i, prose(60)) for i in range(120)]
    value = hexes()[:23] + "-" + hexes()[:16]        # no pattern covers it
    model = sc.train(docs_df(spark, rows))
    rows.append((5000, f'{prose(20)} credential = "{value}" {prose(20)}'))
    got = rows_by_id(sc.scan_secrets(docs_df(spark, rows), model))
    assert got[5000]["n_added"] == 1 and got[5000]["n_hex"] == 0
    kind, a, b = got[5000]["spans"].split(":")
    assert kind == "crf" and value in rows[-1][1][int(a):int(b)]
    assert all(got[1000 + i]["n_added"] == 0 for i in range(120))
    for d, t in rows:
        check(got[d], t)


def test_cut_decoding_equals_the_best_of_all_paths():
    rng = np.random.default_rng(9)
    for _ in range(200):
        n = int(rng.integers(1, 8))
        row = np.sort(rng.integers(0, 3, n))
        features = rng.integers(0, 30, (n, 2))
        weights = np.zeros((30, 3))
        weights[:, 0] = rng.choice([0.0, 6.0], 30)
        weights += rng.normal(0, 1.5, (30, 3))
        model = sc.Model(weights, rng.normal(0, 1, (3, 3)))
        emit = weights[features].sum(axis=1)
        want = np.zeros(n, bool)
        for r in np.unique(row):
            at = np.flatnonzero(row == r)
            best = max(itertools.product(range(3), repeat=len(at)), key=lambda p: sum(emit[i, s] for i, s in zip(at, p))
                       + sum(model.moves[a, b] for a, b in zip(p, p[1:])))
            want[at] = np.array(best) > 0
        assert (model.tag(features, row) == want).all()


def test_long_stretches_equal_plain_viterbi(monkeypatch):
    rng = np.random.default_rng(10)
    for steps in (5_000_000, 200, 1):       # all stretches side by side, some, one at a time
        monkeypatch.setattr(sc, "STEPS_AT_ONCE", steps)
        for share in (0.0, 0.1, 0.6):       # of tokens that are certainly O
            n = 400
            weights = rng.normal(0, 1.5, (n, 3))
            weights[rng.random(n) < share, 0] += 30
            row = np.sort(rng.integers(0, 4, n))
            model = sc.Model(weights, rng.normal(0, 2, (3, 3)))
            want = np.zeros(n, bool)
            for r in np.unique(row):
                at = np.flatnonzero(row == r)
                score, back = weights[at[0]], []
                for t in at[1:]:
                    options = score[:, None] + model.moves
                    back.append(options.argmax(axis=0))
                    score = options.max(axis=0) + weights[t]
                path = [int(score.argmax())]
                for step in reversed(back):
                    path.append(int(step[path[-1]]))
                want[at] = np.array(path[::-1]) > 0
            assert (model.tag(np.arange(n)[:, None], row) == want).all()


def test_odd_rows_and_redaction(spark):
    df = with_clashes(docs_df(spark, ODD + [(30, "é token=abcdefgh, and more"), (31, "password: " + "z" * 50)]))
    rows = sc.scan_secrets(df).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        check(r, next((t or "" for d, t in ODD if d == r["doc_id"]), None) if r["doc_id"] not in (30, 31) else
              {30: "é token=abcdefgh, and more", 31: "password: " + "z" * 50}[r["doc_id"]])
    out = sc.redact_secrets(df)
    assert out.schema == df.schema
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert by_id[30]["text"] == "é [SECRET], and more" and by_id[30]["n_chars"] == len(by_id[30]["text"])
    assert by_id[1]["text"] is None and by_id[6]["text"] == "word " * 4000 and by_id[6]["score"] == "x"
    assert sc.scan_secrets(docs_df(spark, [])).count() == 0 and sc.redact_secrets(docs_df(spark, [])).count() == 0


def test_long_documents_teach_the_field(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("aeioustrn"), rng.integers(2, 8)))
    hexes = lambda: "".join(rng.choice(list("0123456789abcdef"), 40))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f'{prose(40)} token = "{hexes()}" {prose(30)}') for i in range(120)]
    rows += [(1000 + i, prose(60)) for i in range(120)]
    value = hexes()[:23] + "-" + hexes()[:16]
    rows = [(d, t + " " + prose(4000)) for d, t in rows[:60]] + rows[60:]      # some beyond 20,000 characters
    df = docs_df(spark, rows)
    model = sc.train(df)
    assert model is not sc.NOTHING
    rows.append((5000, f'{prose(20)} credential = "{value}" {prose(20)}'))
    got = rows_by_id(sc.scan_secrets(docs_df(spark, rows), model))
    kind, a, b = got[5000]["spans"].split(":")
    assert kind == "crf" and value in rows[-1][1][int(a):int(b)]
    assert all(got[1000 + i]["n_added"] == 0 for i in range(120))


def test_stretches_follow_one_rule_at_every_length(spark):
    long, short = "word " * 9000 + "token=abcdefgh1 " * 50, "token=abcdefgh1 " * 50
    rows = [(1, long), (2, ""), (3, "no secret here"), (4, short), (5, None)]
    blobs = [r[0] for r in docs_df(spark, rows).select("text").mapInArrow(sc._stretches, "stretches binary").collect()]
    cells = [np.frombuffer(b, np.int16).reshape(-1, 2 * sc.WINDOW + 1, 8) for b in blobs]
    assert sorted(len(c) for c in cells) == [0, 0, 1, sc.HITS + 1, sc.HITS + 1]
    for most in (c for c in cells if len(c) > 1):
        assert (most[:sc.HITS, sc.WINDOW, 6] == 1).all() and (most[:, sc.WINDOW, 7] == 1).all()


def test_shape_of_very_long_tokens():
    for body in (b"a", b"7", b"Q", b"-", b"a7"):
        texts = [body * 60_000, body * 70_000, body * 140_000, body * 10]
        off = np.cumsum([0] + [len(t) for t in texts])
        shapes = sc.Piece(np.frombuffer(b"".join(texts), np.uint8), off).features()[:, 0]
        assert len(set(shapes[:3].tolist())) == 1
        assert (shapes[3] - shapes[0]) % 64 == 0       # only the length class differs
