import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qualis.llm.lmscore import lm_scores, pack_ascending, pack_counts, unpack_ascending, unpack_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True), st.lists(st.integers(0, 2**40), min_size=0))
def test_packing_round_trip(hashes, counts):
    x, c = np.array(sorted(hashes), np.uint64), np.array(counts, np.int64)
    assert unpack_ascending(pack_ascending(x)).tolist() == x.tolist()
    assert unpack_counts(pack_counts(c), len(c)).tolist() == c.tolist()


def _brute(texts, order, alpha):
    split = [WORD.findall(t or "") for t in texts]

    def grams(words):
        out = Counter({(): len(words)})
        for k in range(1, order + 1):
            out.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        return out

    own = [grams(w) for w in split]
    total = sum(own, Counter())
    scores = []
    for words, mine in zip(split, own):
        log = backed = 0
        for i, w in enumerate(words):
            longest = k = min(order, i + 1)
            while k and total[tuple(words[i - k + 1:i + 1])] - mine[tuple(words[i - k + 1:i + 1])] <= 0:
                k -= 1
            if k:
                gram = tuple(words[i - k + 1:i + 1])
                log += math.log((total[gram] - mine[gram]) / (total[gram[:-1]] - mine[gram[:-1]]))
            else:
                log -= math.log(total[()] - mine[()] + 1)
            log += (longest - k) * math.log(alpha)
            backed += k < longest
        scores.append((len(words), backed, log))
    return scores


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_brute_force(spark, order):
    rng = np.random.default_rng(order)
    texts = [" ".join(f"w{int(x)}" for x in rng.geometric(0.15, rng.integers(0, 60))) for _ in range(120)]
    texts += ["", None, " \n\t", "alone", "é\x85x y", texts[3], "same " * 400]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, block int, n int")
    got = {r.doc_id: r for r in lm_scores(docs, order=order, block_chars=900, part_ngrams=20).collect()}
    for i, (n, backed, log) in enumerate(_brute(texts, order, 0.4)):
        assert (got[i].n_words, got[i].n_backed_off) == (n, backed) and got[i].log_score == pytest.approx(log, abs=1e-9)
        assert got[i].mean_log_score == (pytest.approx(log / n) if n else None)


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    got = lm_scores(docs).collect()
    assert len(got) == 4 and len({r.log_score for r in got if r.n_words}) == 1
    assert lm_scores(docs.limit(0)).count() == 0


def test_query_scores_every_document(spark):
    from qualis.llm import lmscore

    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = {r.doc_id: r for r in lmscore.query(spark, path).collect()}
    for d, (n, backed, log) in zip(texts, _brute(list(texts.values()), 2, 0.4)):
        assert (got[d].n_words, got[d].n_backed_off) == (n, backed) and got[d].log_score == pytest.approx(log, rel=1e-9)
