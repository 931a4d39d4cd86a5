import hashlib
import random

import numpy as np
import pytest
from llm_helpers import ODD, SF, docs_df, rows_by_id, texts, with_clashes

from geotaxa.llm import prefix_free as pf


def brute(docs):
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            w = b[i:i + 100]
            if w in seen:
                gone[i:i + 100] = True
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) and gone[0])
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def digest(df):
    return {d: tuple(r)[1:5] for d, r in rows_by_id(df).items()}


def planted():
    rng = random.Random(11)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(n))

    passage, base = prose(40), prose(300)
    docs = [(1, base), (2, base), (3, prose(50) + passage + prose(50)), (4, passage), (5, prose(9) + passage[3:130] + "!"),
            (6, "z" * 450), (7, "ab" * 300), (8, "z" * 99), (9, "z" * 100), (10, passage * 3)]
    for k in range(11, 41):  # near copies: each with its own edits
        t = list(base)
        for _ in range(k % 5):
            t[rng.randrange(len(t))] = "#"
        docs.append((k, "".join(t)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("group", [4096, 2])
def test_planted_repeats_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(pf, "GROUP", group)   # 2: the windows of most triggers get a sort of their own
    docs = planted()
    assert digest(pf.remove_repeats(docs_df(spark, docs))) == brute(docs)


def test_query_equals_brute_force(spark):
    assert digest(pf.op4_prefix_free(spark, SF)) == brute(list(texts().items()))


def test_odd_rows(spark):
    rows = pf.remove_repeats(with_clashes(docs_df(spark, ODD + [(9, "no id at all" * 20), (None, "no id at all" * 20)]))).collect()
    assert len(rows) == len(ODD) + 2
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["n_bytes"] == 0 and by_id[1]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[6]["n_bytes"] == 20000 and by_id[6]["n_removed"] == 20000 - 5
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] == 7)
    assert by_id[9]["n_removed"] == 228
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] is None)
    assert pf.remove_repeats(docs_df(spark, [])).count() == 0
    same = pf.remove_repeats(docs_df(spark, [(1, "abc" * 50 + "d" * 60)] * 2)).collect()
    assert [r["n_removed"] for r in same] == [same[0]["n_removed"]] * 2


def test_phrases_depend_on_the_window_alone():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    from geotaxa.llm.text import Spans

    def triggers(part):
        start, count, lead, g, _ = pf.phrases(Spans(part), np.array([0, len(part)]))
        return {int(s) + k: (int(l) - k, int(x)) for s, n, l, x in zip(start, count, lead, g) for k in range(n)}

    whole, part = triggers(text), triggers(text[700:2100])
    assert len(whole) == 2901 and len(part) == 1301
    assert all(whole[700 + i] == v for i, v in part.items())


def test_text_is_shuffled_once(spark):
    from geotaxa.plans.checks import plan_text

    df = pf.op4_prefix_free(spark, SF)
    df.collect()
    plan = plan_text(df)
    final = plan[:plan.find("Initial Plan")]
    moved = [line for line in final.splitlines() if "Exchange hashpartitioning(doc#" in line and "REPARTITION_BY_NUM" in line]
    assert len(moved) == 2 and ["Reused" in line for line in moved].count(True) == 1
