"""Language ID of code-switched text by a linear-chain conditional random field.

Every word (a run of letters) of a text gets a label. A word's scores add up its
features' weights: character n-grams inside it, affixes (n-grams that touch its start or
end, which carry a boundary mark), both hashed to ``2**HASH_BITS`` rows, and the word
itself if the training lexicon holds it. Scores of neighbouring labels come from a learned
transition matrix. Forward-backward gives each word its label probabilities.

The model is fitted on the driver on a bounded sample of every language that labels a text
with letters: ``train_rows`` documents each, fewer where that comes to more than
``max_rows`` in all, but at least one, in hash order of their ids. Texts have up to
``train_chars`` characters; longer ones serve, cut, where a language has no others. Words
take their document's label. A share of the training sequences joins parts of two documents
of different languages, so that the transitions see switches. Fitting is a fixed number of
AdaGrad passes from zero. The model's size grows with the number of languages.

Prediction runs over every whole text in Arrow batches. Feature sums are made once per
distinct word and worker; forward-backward runs over many texts at once, in blocks of
``BLOCK`` words whose transfer matrices are chained, so a very long text takes no more
steps than a short one. From ``WIDE`` languages on texts are not cut into blocks, and fewer
of them are worked on at once.

A document's language has the largest sum of its words' probabilities, weighted by
letters; its score is the weighted mean of that label's probability. A null text or one
without letters is ``und`` with score 0. Repeated rows and null ids are predicted like any
other; extra columns are ignored. An empty table gives an empty result; without a
labelled row every text with letters is ``und``, too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import arrow_batch, text_slices, texts_of

WORD = re.compile(r"[^\W\d_]+")  # letters, and number signs such as a half or a Roman numeral: see words_of
LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"
HASH_BITS = 15
SIZES = (1, 2, 3, 4)
LEXICON_MIN = 3
TRAIN_ROWS, TRAIN_CHARS, MAX_ROWS = 200, 20_000, 12_800
MAX_LABELS = 2000
ORDERS = 2**30
EPOCHS, RATE, DECAY, SWITCHED = 4, 0.3, 1e-6, 0.3
BLOCK, WIDE = 512, 64
CACHE_WORDS = 200_000
SLICE_CHARS = 1_000_000


def words_of(text: str) -> list[str]:
    """The runs of letters (category L) of a text, in lower case."""
    found = WORD.findall(text.lower())
    if found and not "".join(found).isalpha():
        found = [x for w in found for x in ([w] if w.isalpha() else LETTERS.findall(w))]
    return found


def ngram_rows(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hashed row) of every n-gram of each word between boundary marks;
    n-grams that include a mark are its affixes."""
    codes = np.frombuffer(("\0".join(("", *words, ""))).encode("utf-32-le"), np.uint32).astype(np.uint64)
    mark = codes == 0
    owner = np.cumsum(mark) - 1
    whole = len(codes)
    out_w, out_r = [], []
    for n in SIZES:
        if whole <= n:
            continue
        h = np.full(whole - n + 1, n, np.uint64)
        inside = np.zeros(whole - n + 1, np.int64)
        for k in range(n):
            h = (h ^ codes[k:whole - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < k < n - 1:
                inside += mark[k:whole - n + 1 + k]
        first, last = mark[:whole - n + 1], mark[n - 1:]
        ok = (inside == 0) & ~(first & last)  # no mark but at one end
        at = np.flatnonzero(ok)
        # an n-gram that starts with a mark belongs to the word after it
        out_w.append(owner[at])
        out_r.append((h[at] >> np.uint64(64 - HASH_BITS)).astype(np.int64))
    return np.concatenate(out_w), np.concatenate(out_r)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # 2**HASH_BITS x labels
    lexicon: dict[str, int]
    words: np.ndarray  # lexicon x labels
    switch: np.ndarray  # from x to
    start: np.ndarray

    def scores(self, words: Sequence[str]) -> np.ndarray:
        """words x labels."""
        w, r = ngram_rows(words)
        out = np.stack([np.bincount(w, self.weights[r, k], len(words)) for k in range(len(self.labels))], 1)
        known = [(i, self.lexicon[x]) for i, x in enumerate(words) if x in self.lexicon]
        if known:
            i, j = np.array(known).T
            out[i] += self.words[j]
        return out


def forward_backward(emit: np.ndarray, starts: np.ndarray, switch: np.ndarray, start: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(forward, backward) messages of every word of several sequences, each scaled to sum
    1. The sequences are the rows of ``emit`` (positive factors); the i-th begins at
    ``starts[i]``, the last entry is the end, and none is empty. The rows of ``switch`` sum
    to 1, so nothing after a sequence counts the same as a switch into it.

    Sequences are cut into blocks that run in step: first each block's transfer matrix,
    then these are chained along each sequence, then the words of all blocks.
    """
    n, k = emit.shape
    lengths = np.diff(starts)
    per = -(-lengths // block)
    seq = np.repeat(np.arange(len(lengths)), per)
    number = np.arange(len(seq)) - np.repeat(np.cumsum(per) - per, per)
    begin = starts[:-1][seq] + number * block
    size = np.minimum(block, starts[1:][seq] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    live = [*(int(np.searchsorted(-size, -t, side="left")) for t in range(block)), 0]  # blocks longer than t
    entry = np.tile(start, (len(begin), 1))  # message into a block's first word
    leave = np.ones((len(begin), k))  # message into its last word, from behind
    if len(per) and per.max() > 1:
        chained = np.flatnonzero(per[seq[order]] > 1)  # blocks of sequences with several, longest first
        part = np.tile(np.eye(k), (len(chained), 1, 1))
        for t in range(block):
            m = int(np.searchsorted(-size[chained], -t, side="left"))
            part[:m] = (part[:m] * emit[begin[chained[:m]] + t][:, None, :]) @ switch
            part[:m] /= part[:m].sum((1, 2), keepdims=True)
        move = np.empty((len(begin), k, k))
        move[chained] = part
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first = np.cumsum(per) - per
        ahead = np.ones((len(begin), k))  # of a block's first word before its own factor, from behind
        for j in range(1, int(per.max())):
            has = first[per > j]
            v = np.einsum("bi,bij->bj", entry[place[has + j - 1]], move[place[has + j - 1]])
            entry[place[has + j]] = v / v.sum(1, keepdims=True)
        for j in range(int(per.max()) - 1, 0, -1):
            has = first[per > j]
            here = place[has + j]
            later = np.where((per[per > j] > j + 1)[:, None], ahead[place[np.minimum(has + j + 1, len(order) - 1)]], 1.0)
            v = np.einsum("bij,bj->bi", move[here], later)
            ahead[here] = v / v.sum(1, keepdims=True)
            leave[place[has + j - 1]] = ahead[here] @ switch.T
    forward, backward = np.empty((n, k)), np.empty((n, k))
    message = entry
    for t in range(block):
        m = live[t]
        at = begin[:m] + t
        a = message[:m] * emit[at]
        a /= a.sum(1, keepdims=True)
        forward[at] = a
        message = a @ switch
    for t in range(block - 1, -1, -1):
        m, inner = live[t], live[t + 1]
        if inner:
            v = (emit[begin[:inner] + t + 1] * leave[:inner]) @ switch.T
            leave[:inner] = v / v.sum(1, keepdims=True)
        backward[begin[:m] + t] = leave[:m]
    return forward, backward


def block_words(labels: int, starts: np.ndarray) -> int:
    """Chaining blocks takes labels**3 steps a word: with many labels one block a sequence."""
    return BLOCK if labels <= WIDE else int(np.diff(starts).max(initial=1))


def narrowed(amount: int, labels: int) -> int:
    """``amount`` texts or words, less in proportion to the labels above ``WIDE``."""
    return amount * WIDE // max(WIDE, labels)


def marginals(emit: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    f, b = forward_backward(emit, starts, model.switch, model.start, block_words(len(model.labels), starts))
    f *= b
    f /= f.sum(1, keepdims=True)
    return f


def factors(scores: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(scores - scores.max(1, keepdims=True), -60))


def training_sequences(texts: Sequence[list[str]], langs: Sequence[int], rng: np.random.Generator) -> list[tuple[list[str], np.ndarray]]:
    """Each text once: alone, or (a share of them) its first part followed by the second
    part of a text of another label."""
    out = []
    for words, lang in zip(texts, langs, strict=True):
        other = int(rng.integers(len(texts)))
        if rng.random() < SWITCHED and langs[other] != lang:
            a, b = int(rng.integers(1, len(words) + 1)), int(rng.integers(len(texts[other])))
            tail = texts[other][b:]
            out.append((words[:a] + tail, np.array([lang] * a + [langs[other]] * len(tail))))
        else:
            out.append((words, np.full(len(words), lang)))
    return out


def fit(rows: Sequence[tuple[str, str]], epochs: int = EPOCHS, rate: float = RATE, batch_words: int = 20_000, seed: int = 7) -> Model:
    """A model of (text, language) rows by AdaGrad on the conditional log-likelihood."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in rows})
    texts, langs = [], []
    for text, lang in rows:
        words = WORD.findall(text.lower())
        if words:
            texts.append(words)
            langs.append(labels.index(lang))
    k = len(labels)
    seen = Counter(w for t in texts for w in t)
    lexicon = {w: i for i, w in enumerate(sorted(w for w, c in seen.items() if c >= LEXICON_MIN))}
    table = {w: i for i, w in enumerate(seen)}
    vocabulary = list(table)
    pair_w, pair_r = ngram_rows(vocabulary) if vocabulary else (np.empty(0, int), np.empty(0, int))
    by_word = np.argsort(pair_w, kind="stable")
    pair_r = pair_r[by_word]
    pair_at = np.concatenate([[0], np.cumsum(np.bincount(pair_w, minlength=len(vocabulary)))])
    lex = np.array([lexicon.get(w, -1) for w in vocabulary], int)
    weights, words_w, t_w, s_w = np.zeros((2**HASH_BITS, k)), np.zeros((len(lexicon), k)), np.zeros((k, k)), np.zeros(k)
    past = [np.full_like(x, 1e-8) for x in (weights, words_w, t_w, s_w)]

    def soft(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(-1, keepdims=True, initial=-np.inf))
        return e / e.sum(-1, keepdims=True)

    def ascend(x: np.ndarray, grad: np.ndarray, sums: np.ndarray) -> None:
        sums += grad * grad
        x += rate * grad / np.sqrt(sums) - DECAY * x

    for _ in range(epochs if k > 1 else 0):
        sequences = training_sequences(texts, langs, rng)
        rng.shuffle(sequences)  # type: ignore[arg-type]
        batch: list = []
        for last, s in ((i == len(sequences) - 1, s) for i, s in enumerate(sequences)):
            batch.append(s)
            if not last and sum(len(w) for w, _ in batch) < batch_words:
                continue
            flat = np.array([table[w] for ws, _ in batch for w in ws])
            gold = np.concatenate([g for _, g in batch])
            starts = np.concatenate([[0], np.cumsum([len(w) for w, _ in batch])])
            batch = []
            used, at = np.unique(flat, return_inverse=True)
            n_pairs = pair_at[used + 1] - pair_at[used]
            take = np.repeat(pair_at[used] - np.concatenate([[0], np.cumsum(n_pairs)[:-1]]), n_pairs) + np.arange(n_pairs.sum())
            pw, pr = np.repeat(np.arange(len(used)), n_pairs), pair_r[take]
            known = np.flatnonzero(lex[used] >= 0)
            score = np.stack([np.bincount(pw, weights[pr, j], len(used)) for j in range(k)], 1)
            score[known] += words_w[lex[used[known]]]
            emit, switch, start = factors(score)[at], soft(t_w), soft(s_w)
            f, b = forward_backward(emit, starts, switch, start, block_words(k, starts))
            p = f * b
            p /= p.sum(1, keepdims=True)
            inside = np.ones(len(flat) - 1, bool)
            inside[starts[1:-1] - 1] = False
            here, after = f[:-1][inside], (emit * b)[1:][inside]
            here /= ((here @ switch) * after).sum(1, keepdims=True)
            moves = np.bincount(gold[:-1][inside] * k + gold[1:][inside], minlength=k * k).reshape(k, k) - switch * (here.T @ after)
            first = np.bincount(gold[starts[:-1]], minlength=k) - p[starts[:-1]].sum(0)
            diff = np.eye(k)[gold] - p
            word_grad = np.stack([np.bincount(at, diff[:, j], len(used)) for j in range(k)], 1)
            ascend(weights, np.stack([np.bincount(pr, word_grad[pw, j], len(weights)) for j in range(k)], 1), past[0])
            grad = np.zeros_like(words_w)
            grad[lex[used[known]]] = word_grad[known]
            ascend(words_w, grad, past[1])
            ascend(t_w, moves - moves.sum(1, keepdims=True) * switch, past[2])
            ascend(s_w, first - first.sum() * start, past[3])
    return Model(labels, weights, lexicon, words_w, soft(t_w), soft(s_w))


class _Words(dict):
    """word -> number; new words get the next number and are noted."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


@dataclass
class Labeller:
    """Words to label probabilities, with the scores of known words kept."""

    model: Model
    words: _Words = field(default_factory=_Words)
    emit: np.ndarray | None = None

    def __call__(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        if len(self.words) > narrowed(CACHE_WORDS, len(self.model.labels)):
            self.words, self.emit = _Words(), None
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if self.words.fresh:
            new = factors(self.model.scores(self.words.fresh))
            self.emit = new if self.emit is None else np.concatenate([self.emit, new])
            self.words.fresh = []
        starts = np.concatenate([[0], np.cumsum(lengths[lengths > 0])])
        return marginals(self.emit[at], starts, self.model)


def training_sample(docs: DataFrame, trained_on, train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS,
                    max_rows: int = MAX_ROWS) -> list[tuple[str, str]]:
    """About ``train_rows`` (text, lang) rows of each language, or ``max_rows`` in all, and at
    least one of each, in hash order. Rows that repeat an id and language are one."""
    long = F.char_length("text") > train_chars
    order = F.pmod(F.xxhash64("doc_id"), F.lit(ORDERS)) + F.when(long, ORDERS).otherwise(0)
    rows = docs.where(trained_on & F.col("lang").isNotNull()).select("lang", "text", order.alias("_order"))
    lettered = F.col("text").rlike(r"\p{L}")
    langs = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.when(lettered, F.col("_order"))).alias("least")).where("least is not null").collect()
    if not langs:
        return []
    if len(langs) > MAX_LABELS:
        raise ValueError(f"{len(langs)} languages: every task holds the model, 256 KB a language; clean the labels or raise MAX_LABELS")
    each = max(1, min(train_rows, max_rows // len(langs)))
    cuts = docs.sparkSession.createDataFrame(
        [(r.lang, max(r.least, r.least // ORDERS * ORDERS + min(ORDERS - 1, ORDERS * each // r.n + 1))) for r in langs], "_lang string, _last long")
    text = F.when(long, F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{train_chars - 1}}}", 0)).otherwise(F.col("text"))
    sample = (rows.join(F.broadcast(cuts), (F.col("lang") == F.col("_lang")) & (F.col("_order") <= F.col("_last"))).where(lettered)
              .groupBy("lang", "_order").agg(F.min(text).alias("text")).orderBy("_order", "lang"))
    return [(r.text, r.lang) for r in sample.collect()]


def predict(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score, and lang_shares: each language's part of the letters."""
    rows = docs.select(*keep, F.col("text").alias("_text"))
    result = "lang_pred string, score double, lang_shares map<string,double>"
    schema = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("lang_shares", pa.map_(pa.string(), pa.float64()))])
    fields = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(model)
        for batch in batches:
            for at, texts in text_slices(texts_of(batch.column(len(keep))), narrowed(SLICE_CHARS, len(model.labels))):
                words: list[str] = []
                lengths = np.empty(len(texts), np.int64)
                for i, t in enumerate(texts):
                    found = words_of(t)
                    lengths[i] = len(found)
                    words += found
                shares = np.zeros((len(texts), len(model.labels)))
                if words and model.labels:
                    p = label(words, lengths)
                    letters = np.fromiter(map(len, words), np.float64, len(words))
                    has = lengths > 0
                    starts = (np.cumsum(lengths) - lengths)[has]
                    sums = np.add.reduceat(p * letters[:, None], starts)
                    shares[has] = sums / sums.sum(1, keepdims=True)
                best = shares.argmax(1) if model.labels else np.zeros(len(texts), int)
                top = shares.max(1, initial=0.0)
                part = batch.slice(at, len(texts))
                new = arrow_batch({"lang_pred": [model.labels[b] if t > 0 else UNKNOWN for b, t in zip(best, top, strict=True)],
                                   "score": np.minimum(top, 1.0),
                                   "lang_shares": [[(c, float(v)) for c, v in zip(model.labels, row, strict=True) if v >= 0.01] for row in shares]}, schema)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *new.columns], names=[*keep, *schema.names])

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), result]))


def label_runs(docs: DataFrame, model: Model) -> DataFrame:
    """One row per run of words with the same label: doc_id, start, end (characters of the
    text), lang and the mean probability of the run's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(model)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for i, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                spans = list(LETTERS.finditer(text or ""))
                if not spans or not model.labels:
                    continue
                p = label([m.group().lower() for m in spans], np.array([len(spans)]))
                best = p.argmax(1)
                cuts = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(spans)]
                out += [(i, spans[a].start(), spans[b - 1].end(), model.labels[best[a]], float(p[a:b, best[a]].mean()))
                        for a, b in zip(cuts, cuts[1:], strict=False)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()), strict=True)],
                                                 names=["doc_id", "start", "end", "lang", "p"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, end long, lang string, p double")
