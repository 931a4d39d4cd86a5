import hashlib
import random

import numpy as np
import pytest
from llm_helpers import ODD, SF, docs_df, rows_by_id, texts, with_clashes

from geotaxa.llm import edit_embedding as ee


def brute(pairs):
    """doc_id -> (text, half-edited text), next by descending doc_id."""
    order = sorted(pairs, key=lambda p: p[0], reverse=True)
    out = {}
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        out[d] = (t, t[:len(t) - half] + nxt[:half], nxt)
    return out


def print_of(text):
    codes = ee.char_codes(text)
    return ee.bits_of(codes, ee.walk(codes))


def test_query_equals_a_plain_walk_of_both_texts(spark):
    want = brute(list(texts().items()))
    got = rows_by_id(ee.op1_edit_fingerprint(spark, SF))
    assert set(got) == set(want)
    for d, (text, edited, nxt) in want.items():
        r, own, other, after = got[d], print_of(text), print_of(edited), print_of(nxt)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (ee.fingerprint(own), ee.fingerprint(other))
        assert r["near_edited"] == ee.likeness(own, other) and r["near_next"] == ee.likeness(own, after)
    assert sum(r["near_edited"] > r["near_next"] for r in got.values() if r["n_chars"] > 40) > 0.95 * len(got)


def test_odd_texts_and_rows(spark):
    df = with_clashes(docs_df(spark, ODD))
    rows = ee.fingerprint_edits(df).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == "0:" and by_id[1]["near_edited"] == 1.0
    assert by_id[7]["fingerprint"] == by_id[8]["fingerprint"]
    assert by_id[4]["n_chars"] == 1 and by_id[5]["n_chars"] == len(ODD[4][1])
    # the row without a doc_id is last in descending order; the first follows it
    assert by_id[1]["near_next"] == ee.likeness(print_of(""), print_of("no id at all"))
    assert by_id[None]["near_next"] == ee.likeness(print_of("no id at all"), print_of("same text here"))
    assert ee.fingerprint_edits(docs_df(spark, [])).count() == 0
    one = ee.fingerprint_edits(docs_df(spark, [(9, "abcdef")])).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


def test_buckets_do_not_change_the_result(spark):
    rows = [(i * i, f"text number {i} " * (i % 7 + 1)) for i in range(60)]
    a = sorted(map(tuple, ee.fingerprint_edits(docs_df(spark, rows), buckets=1).collect()))
    b = sorted(map(tuple, ee.fingerprint_edits(docs_df(spark, rows), buckets=37).collect()))
    assert a == b


def test_likeness_falls_with_edits_and_links_are_found(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ij") for _ in range(4000))

    def edited(n):
        t = list(text)
        for _ in range(n):
            i = rng.randrange(len(t))
            t[i:i + 1] = rng.choice([[], [rng.choice("xyz")], [t[i], "q"]])
        return "".join(t)

    near = [ee.likeness(print_of(text), print_of(edited(n))) for n in (0, 2, 400)]
    assert near[0] == 1.0 and near[1] > near[2] and near[1] > 0.6
    other = "".join(rng.choice("abcdefgh ij") for _ in range(4000))
    df = docs_df(spark, [(1, text), (2, text), (3, text[:3900] + "changed end"), (4, other)])
    links = {(r["other_id"], r["doc_id"]) for r in ee.near_links(ee.fingerprint_edits(df)).collect()}
    assert links == {(1, 2), (1, 3)}


@pytest.mark.parametrize("part", [512, 20])
def test_links_among_many_unrelated_documents_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(ee, "PART_PRINTS", part)      # 20: buckets are compared in parts
    rng = np.random.default_rng(8)
    rows = [rng.integers(0, 2, rng.integers(129, 257), np.uint8) for _ in range(1500)]
    for k in range(60):                               # near texts, 5 % of the bits changed
        near = rows[25 * k].copy()
        near[rng.choice(len(near), len(near) // 20, replace=False)] ^= 1
        rows.append(near)
    rows.append(rows[7])                              # a copy
    ids = rng.permutation(len(rows)) + 1              # near texts are rarely the smallest of their bucket
    prints = [(int(i), ee.fingerprint(b)) for i, b in zip(ids, rows)] + [(9001, "0:"), (9002, "0:"), (None, ee.fingerprint(rows[0]))]
    df = spark.createDataFrame(prints, "doc_id long, fingerprint string")
    got = {(r["other_id"], r["doc_id"]): r["likeness"] for r in ee.near_links(df, bands=8, bits=5).collect()}
    want = {}
    for a in range(len(rows)):
        for b in range(a):
            both = min(len(rows[a]), len(rows[b]))
            if np.count_nonzero(rows[a][:both] == rows[b][:both]) > 0.75 * both:
                like = ee.likeness(rows[a], rows[b])
                if like >= 0.7:
                    want[tuple(sorted((int(ids[a]), int(ids[b]))))] = like
    assert len(want) == 61 and got == want
