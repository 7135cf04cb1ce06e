"""Trained operators and packing: forward-backward by brute force, held-out accuracy, round trips."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import SF_MID, no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from clickweave.llm import crf_langid, lsa_knn, vector_pack
from clickweave.llm.common import fold_of, is_held_out, text_slices


@pytest.mark.parametrize("block", [1, 3, 64])
def test_forward_backward(block):
    rng = np.random.default_rng(1)
    lengths = [1, 2, 7, 64, 65, 130, 3]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    emit = rng.random((starts[-1], 3)) + 0.01
    switch = rng.random((3, 3))
    switch /= switch.sum(1, keepdims=True)
    start = np.array([0.2, 0.5, 0.3])
    f, b = crf_langid.forward_backward(emit, starts, switch, start, block)
    got = f * b / (f * b).sum(1, keepdims=True)
    for a, z in zip(starts, starts[1:], strict=False):
        alpha, beta = np.zeros((z - a, 3)), np.ones((z - a, 3))
        for t in range(z - a):
            alpha[t] = (start if t == 0 else alpha[t - 1] @ switch) * emit[a + t]
            alpha[t] /= alpha[t].sum()
        for t in range(z - a - 2, -1, -1):
            beta[t] = switch @ (emit[a + t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        want = alpha * beta
        assert np.allclose(got[a:z], want / want.sum(1, keepdims=True))


def test_ngram_rows_belong_to_their_words():
    words = ["ab", "a", "xyz"]
    w, r = crf_langid.ngram_rows(words)
    together = {i: Counter(r[w == i]) for i in range(3)}
    for i, x in enumerate(words):
        assert together[i] == Counter(crf_langid.ngram_rows([x])[1])
    # ab: a, b, ^a, ab, b$, ^ab, ab$ (4-grams need a third letter)
    assert sum(together[0].values()) == 7


def test_crf_labels_switched_text(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = crf_langid.fit(crf_langid.training_sample(docs, fold_of() != 2))
    rows = crf_langid.predict(docs, model, keep=("doc_id", "lang")).where(is_held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    mixed = spark.createDataFrame([(1, "the thing that they are in and the there of this und der die einer nicht schen lich keit")], "doc_id long, text string")
    runs = crf_langid.label_runs(mixed, model).orderBy("start").collect()
    assert runs[0].lang == "en" and runs[-1].lang == "de"
    assert all(a.end <= b.start for a, b in zip(runs, runs[1:], strict=False))


def test_crf_odd_rows(spark, odd_docs, no_docs):
    model = crf_langid.fit(crf_langid.training_sample(odd_docs, fold_of() != 2))
    rows = crf_langid.predict(odd_docs, model, keep=("doc_id", "text")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert (0 < r.score <= 1) if letters else r.score == 0
    none = crf_langid.fit(crf_langid.training_sample(no_docs, fold_of() != 2))
    assert {r.lang_pred for r in crf_langid.predict(odd_docs, none).collect()} == {"und"}
    assert crf_langid.predict(no_docs, model).count() == 0


def many_langs(spark, langs, docs_each, length=40):
    """Documents of languages that share no word; a language's words start with its own two letters."""
    rng = np.random.default_rng(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(langs):
        words = [letters[k % 26] + letters[k // 26] + "".join(rng.choice(list(letters), 3)) for _ in range(25)]
        rows += [(k * 1000 + j, f"l{k:03}", " ".join(rng.choice(words, length))) for j in range(docs_each + k % 2)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)


def test_number_signs_are_no_letters(spark):
    assert crf_langid.words_of("½ ² Ⅷ ① 42 _") == [] and crf_langid.words_of("m² Ⅷth Ünï½cöde x_y") == ["m", "th", "ünï", "cöde", "x", "y"]
    docs = spark.createDataFrame([(1, "½ ² Ⅷ ①", None), (2, "guter Text", None)], "doc_id long, text string, lang string")
    model = crf_langid.fit([("the cat and the dog", "en"), ("der Hund und die Katze", "de")])
    got = {r.doc_id: r.lang_pred for r in crf_langid.predict(docs, model).collect()}
    assert got[1] == "und" and got[2] in ("en", "de")


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(crf_langid, "MAX_LABELS", 2)
    docs = spark.createDataFrame([(i, "word", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="3 languages"):
        crf_langid.training_sample(docs, docs.doc_id >= 0)


def test_crf_learns_every_language(spark):
    docs = many_langs(spark, 70, 8)
    sample = crf_langid.training_sample(docs, docs.doc_id >= 0)
    assert len({lang for _, lang in sample}) == 70
    rows = crf_langid.predict(docs, crf_langid.fit(sample), keep=("doc_id", "lang")).collect()
    right = {r.lang for r in rows if r.lang == r.lang_pred}
    assert len(right) == 70 and sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97


def test_crf_sample_is_bounded_over_the_languages(spark):
    docs = many_langs(spark, 30, 60, 5)
    sample = crf_langid.training_sample(docs, docs.doc_id >= 0, max_rows=90)
    assert len({lang for _, lang in sample}) == 30 and len(sample) < 180
    # also a language of long texts, of repeated rows, or with a single row that has letters
    odd = spark.createDataFrame([(1, "long", "- " * 100 + "abc " * 100), (2, "one", "12"), (3, "one", "word"), (5, "none", None), (6, None, "x")]
                                + [(4, "same", "again")] * 50, "doc_id long, lang string, text string")
    sample = crf_langid.training_sample(odd, odd.doc_id >= 0, train_rows=1, train_chars=20)
    assert {lang for _, lang in sample} == {"long", "one", "same"}
    assert max(len(t) for t, _ in sample) <= 20 and all(any(c.isalpha() for c in t) for t, _ in sample) and len(sample) <= 6


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = lsa_knn.fit(*lsa_knn.training_sample(docs, labels, fold_of() != 2))
    rows = lsa_knn.score(docs, model).join(labels, "doc_id").where(is_held_out()).collect()
    right = [(r.score >= lsa_knn.PREDICT_AT) == (r.quality == 1) for r in rows]
    assert sum(right) / len(right) >= 0.95
    good = [r.score >= lsa_knn.PREDICT_AT for r in rows if r.quality == 1]
    assert sum(good) / len(good) >= 0.98


def test_quality_votes_are_exact():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(300, 6)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    good = rng.random(300) < 0.5
    model = lsa_knn.Model(rng.normal(size=(lsa_knn.TERMS, 6)).astype(np.float32), vectors, good, 0.8)
    counts = rng.random((7, lsa_knn.TERMS)).astype(np.float32)
    got = model.score(counts, k=10, sharpness=4.0)
    for c, s in zip(counts, got, strict=True):
        v = c @ model.project
        near = vectors @ (v / np.linalg.norm(v))
        best = np.argsort(-near)[:10]
        w = np.maximum(near[best], 0) ** 4 * np.where(good[best], 0.8 / good.mean(), 0.2 / (1 - good.mean()))
        assert math.isclose(s, (w * good[best]).sum() / w.sum(), rel_tol=1e-3)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        model = lsa_knn.fit(*lsa_knn.training_sample(odd_docs, known, fold_of() != 2))
        rows = lsa_knn.score(odd_docs, model, keep=("doc_id", "text")).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert lsa_knn.score(no_docs, model).count() == 0


def test_text_slices():
    texts = [None, "a" * 5, "b" * 20, "", "c"]
    got = list(text_slices(texts, 6))
    assert [t for _, s in got for t in s] == ["", "a" * 5, "b" * 20, "", "c"]
    assert [at for at, _ in got] == [0, 2, 3]


def test_ids_equal_the_tokenizer():
    rng = np.random.default_rng(5)
    bits = ["a", "B", "é", "1", "²", ".", ",", "'", "s", "n't", "'re", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\u00a0", "\x1c", "日本", "!!", "<|endoftext|>", "😀", "_", "?", "\x85", "'ll", "\u3000"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 20))) for _ in range(3000)]
    whole = Tokenizer.from_file(vector_pack.tokenizer_file(vector_pack.TOKENIZER))
    encode = vector_pack.IdBytes(vector_pack.TOKENIZER)
    for at in range(0, 3000, 500):
        for t, raw in zip(texts[at:at + 500], encode(texts[at:at + 500]), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_cut():
    assert list(vector_pack.cut(5, 4)) == [(0, 1), (1, 4)]
    assert list(vector_pack.cut(8, 4)) == [(0, 4), (4, 4)]
    assert list(vector_pack.cut(3, 4)) == [(0, 3)]


@pytest.mark.parametrize(("max_docs", "max_cost", "rule"), [(1000, 1e9, "residual_norm"), (3, 1e9, "residual_norm"), (5, 1e4, "residual_norm"), (4, 2e4, "dot_product")])
def test_best_fit_keeps_every_capacity(max_docs, max_cost, rule):
    rng = np.random.default_rng(9)
    lengths = np.sort(rng.integers(1, 101, 700))[::-1]
    bins = vector_pack.best_fit(lengths, 100, max_docs, max_cost, rule)
    assert np.bincount(bins, lengths).max() <= 100
    assert np.bincount(bins).max() <= max_docs
    assert np.bincount(bins, lengths.astype(float)**2).max() <= max_cost
    assert set(bins) == set(range(bins.max() + 1))
    if max_docs == 1000:
        left: list[int] = []  # one capacity only: plain best fit
        for n in lengths.tolist():
            fit = [i for i, r in enumerate(left) if r >= n]
            if fit:
                left[min(fit, key=left.__getitem__)] -= n
            else:
                left.append(100 - n)
        assert bins.max() + 1 <= len(left) + 1


def test_pack_round_trip(odd_docs, no_docs):
    whole = Tokenizer.from_file(vector_pack.tokenizer_file(vector_pack.TOKENIZER))
    rows = vector_pack.pack(odd_docs, group_rows=20).collect()
    want = Counter()
    for r in odd_docs.select("doc_id", "text").collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or min(len(ids), 2048)
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want.update((r.doc_id, i, a, z - a, zlib.crc32(ids[a:z].tobytes())) for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert vector_pack.pack(no_docs).count() == 0


@pytest.mark.parametrize("rule", ["residual_norm", "dot_product"])
@pytest.mark.parametrize(("max_docs", "max_cost", "weights"), [(32, 1e4, (1.0, 0.05, 0.05)), (4, 1e4, (1.0, 1.0, 1.0)), (1000, 1.5e4, (0.2, 0.5, 1.0)), (3, 1e9, (1.0, 0.0, 0.0))])
def test_best_fit_takes_the_best_bin(rule, max_docs, max_cost, weights):
    """Every choice against all open bins, one by one."""
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(1, 101, 500))[::-1]
    bins = vector_pack.best_fit(lengths, 100, max_docs, max_cost, rule, weights)
    cap, left = (100, max_docs, max_cost), []
    for n, got in zip(lengths.tolist(), bins.tolist(), strict=True):
        need, best = (n, 1, n * n), None
        for b, r in enumerate(left):
            if all(x >= y for x, y in zip(r, need, strict=True)):
                if rule == "residual_norm":
                    score = sum(w * ((x - y) / c) ** 2 for w, x, y, c in zip(weights, r, need, cap, strict=True))
                else:
                    score = -sum(w * (y / c) * (x / c) for w, x, y, c in zip(weights, r, need, cap, strict=True))
                if best is None or score < best[0] - 1e-15:
                    best = (score, b)
        if best is None:
            left.append(list(cap))
            assert got == len(left) - 1
        else:
            scored = sum(w * ((x - y) / c) ** 2 for w, x, y, c in zip(weights, left[got], need, cap, strict=True)) if rule == "residual_norm" else \
                -sum(w * (y / c) * (x / c) for w, x, y, c in zip(weights, left[got], need, cap, strict=True))
            assert abs(scored - best[0]) < 1e-12  # the best, up to rounding
        left[got] = [x - y for x, y in zip(left[got], need, strict=True)]
    assert all(min(r) >= 0 for r in left)


def test_pack_is_near_the_bound(spark):
    rows = vector_pack.pack(spark.read.parquet(f"{SF_MID}/documents.parquet")).collect()
    assert len({r.sequence_id for r in rows}) <= 1.01 * math.ceil(sum(r.length for r in rows) / 2048) + 1
