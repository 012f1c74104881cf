import collections
import random
import re

import numpy as np

from starloom.llm import quality
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_counts_of_every_text(spark):
    texts = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().set_index("doc_id").text
    got = quality.op6_quality_mcd(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        n, *_, repeated = want = plain(texts[r.doc_id])
        assert counts(r) == want
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.base_failed and r.kept)


def test_counts_of_odd_texts(docs_of):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x " * 50, "l\nl\n l\n\n\nl", "#*$%&|<> é\x85\xa0日", "a b c d e f " * 3000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    got = {r.doc_id: r for r in quality.text_statistics(docs_of(list(enumerate(texts)), clash=True)).collect()}
    for i, t in enumerate(texts):
        assert counts(got[i]) == plain(t), repr(t)


def plain_mcd(x, support, steps):
    """The same steps in numpy, with exact quantiles."""
    floors = np.array(quality.FLOORS)

    def quantile(v, q):
        return np.sort(v)[int(np.ceil(q * len(v))) - 1]
    centre = np.array([quantile(c, 0.5) for c in x.T])
    scale = np.array([quantile(np.abs(c - m), 0.5) for c, m in zip(x.T, centre, strict=True)])
    d2 = (((x - centre) / np.maximum(1.4826 * scale, floors)) ** 2).sum(axis=1)
    for _ in range(steps):
        near = x[d2 <= quantile(d2, support)]
        centre, cov = near.mean(axis=0), np.cov(near.T, bias=True) + np.diag(floors ** 2)
        d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
    return np.sqrt(d2 / max(quantile(d2, 0.5) / quality.CHI2_MEDIAN, 1.0))


def test_distances_match_numpy(docs_of):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(rng.randint(12, 90))]
        if i % 40 == 0:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "en" if i % 4 else None, ["a", None][i % 2]))
    got = quality.robust_outliers(quality.text_statistics(docs_of(rows))).collect()
    assert len(got) == len(rows)
    groups = collections.defaultdict(list)
    for r in got:
        if not r.base_failed:
            groups[r.lang, r.source].append(r)
    for own in groups.values():
        assert len(own) >= quality.LEAST_ROWS
        n = np.array([r.n_words for r in own], float)
        x = np.stack([np.log1p(n), np.log(np.array([r.word_chars for r in own]) / n),
                      *[np.log1p(100 * np.array([r[c] for r in own]) / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]], axis=1)
        want = plain_mcd(x, quality.SUPPORT, quality.STEPS)
        assert np.allclose([r.distance for r in own], want, rtol=1e-6)
        assert [r.kept for r in own] == (want <= quality.CUTOFF ** 0.5).tolist()
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[i] for i in range(0, 400, 40)) and sum(kept.values()) >= 380


def test_small_pools_and_empty_tables(docs_of):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20)), f"l{i}", f"s{i}") for i in range(5)] + [(9, None, None, None)]
    got = {r.doc_id: (r.kept, r.distance) for r in quality.robust_outliers(quality.text_statistics(docs_of(rows))).collect()}
    assert got == {**{i: (True, None) for i in range(5)}, 9: (False, None)}
    assert quality.robust_outliers(quality.text_statistics(docs_of([]))).count() == 0
