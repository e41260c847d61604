"""Quality rules: base counts, then line labels of a linear-chain conditional random field.

Each line with a word has features (length, symbols, capitals, digits, line end, repeats inside it and in the text, place).
A chain of two labels, boilerplate and content, is trained on lines of a bounded number of labelled documents. Lines of
documents of low quality are boilerplate. So are, in documents of high quality, lines that repeat an earlier line of the
text and lines that recur in RECUR documents or more, most of which are unrelated (so that copies of a document are no
recurrence); their other lines are content. Viterbi decoding labels the lines of every document; the share of words in
content lines decides.

Defined results: a null text has no words and fails; a text without words has 0 for every count; rows with repeated or
null ids stay rows of their own; labels with a null id or quality are left out, equal ids in labels count once (lowest
quality); without any usable label of both kinds every document that passes the base rules is kept; other columns of
documents are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import column, hash_spans, hash_windows, lean, mix, prepare, slices, text_bytes, unlike, words_of

#: Labelled documents, and pieces of PIECE neighbouring lines of each, that the chain is fitted on: those whose hashes are
#: lowest, wherever in a text they stand (training alone is bounded).
TRAIN_DOCS, TRAIN_PIECES, PIECE = 2_000, 8, 32
#: Unrelated documents in which a line recurs from which it is boilerplate, and their least share among those that have it.
RECUR, UNRELATED = 3, 0.7
#: Share of words in content lines from which a document is kept.
CONTENT_SHARE = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
N_FEATURES = 17


def _table(of: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(of)] = True
    return t


_SYMBOL, _UPPER, _LOWERS = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_DIGIT, _END, _PUNCT = _table(b"0123456789"), _table(b".!?;:\""), _table(b"!?,;:()[]{}\"'/\\-_=+~^@`")
_POINT = np.ones(256, bool)
_POINT[0x80:0xC0] = False


@dataclass
class Measured:
    """Counts of the texts of a slice; their lines with a word: features, words, and where the lines of each text begin."""

    counts: np.ndarray  # texts x (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
    features: np.ndarray
    line_words: np.ndarray
    line_bounds: np.ndarray
    line_hash: np.ndarray
    line_dup: np.ndarray


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _earlier(keys: np.ndarray) -> np.ndarray:
    """Whether an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return same


def measure(texts: pa.Array) -> Measured:
    data, ends = text_bytes(texts)
    starts, stops, bounds = words_of(data, ends)
    n_docs = len(ends) - 1
    point, symbol = _sums(_POINT[data]), _sums(_SYMBOL[data])
    word_hash = hash_spans(data, starts, stops)
    doc_of_word = np.repeat(np.arange(n_docs), np.diff(bounds))
    word_points = _sums(point[stops] - point[starts])

    windows, before = hash_windows(word_hash, bounds, 3)
    doc_of_window = np.repeat(np.arange(n_docs), np.diff(before))
    keys = mix(windows ^ mix(doc_of_window.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = (np.arange(len(keys)) - before[doc_of_window] + bounds[doc_of_window])[twice]
    repeated = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        repeated[at + k] = True
    repeat = _sums(repeated[: len(starts)])

    # lines: between \n and the ends of texts; those without a word are left out
    newline = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([newline + 1, ends]))
    line_start, line_stop = edges[:-1], edges[1:].copy()
    line_stop -= data[line_stop - 1] == 10 if len(line_stop) else 0
    first, last = np.searchsorted(starts, line_start), np.searchsorted(starts, line_stop)
    real = last > first
    line_start, line_stop, first, last = line_start[real], line_stop[real], first[real], last[real]
    doc_of_line = np.searchsorted(ends, line_start, "right") - 1
    line_hash = hash_spans(data, line_start, line_stop)
    dup = _earlier(mix(line_hash ^ mix(doc_of_line.astype(np.uint64))))
    line_bounds = np.searchsorted(line_start, ends, "left")
    dups = _sums(dup)

    counts = np.stack([np.diff(bounds), np.diff(word_points[bounds]), np.diff(symbol[ends]), np.diff(dups[line_bounds]), np.diff(repeat[bounds])], axis=1)

    n = (last - first).astype(float)
    chars = np.maximum(1, word_points[last] - word_points[first]).astype(float)
    share = lambda t: (lambda c: (c[line_stop] - c[line_start]) / chars)(_sums(t[data]))
    upper, lower, digit, punct = share(_UPPER), share(_LOWERS), share(_DIGIT), share(_PUNCT)
    follows = np.zeros(len(starts), bool)
    follows[1:] = (word_hash[1:] == word_hash[:-1]) & (doc_of_word[1:] == doc_of_word[:-1])
    adjacent = _sums(follows)
    word_end = data[stops[last - 1] - 1] if len(last) else np.zeros(0, np.uint8)
    word_symbol = _sums(symbol[stops] > symbol[starts])
    first_line, last_line = np.zeros(len(n), bool), np.zeros(len(n), bool)
    some = line_bounds[1:] > line_bounds[:-1]
    first_line[line_bounds[:-1][some]] = last_line[line_bounds[1:][some] - 1] = True
    features = np.stack([
        np.ones(len(n)), np.log1p(n) / 4, n < 4, np.minimum(1, (symbol[line_stop] - symbol[line_start]) / chars * 4),
        (word_symbol[last] - word_symbol[first]) / n, upper / np.maximum(upper + lower, 1e-9), np.minimum(1, digit * 3), np.minimum(1, punct * 3),
        _END[word_end], dup, first_line, last_line, n < 9, np.maximum(0, adjacent[last] - adjacent[np.minimum(first + 1, last)]) / n, (repeat[last] - repeat[first]) / n, np.abs(chars / n - 5.5) / 5, chars / n > 12,
    ], axis=1).astype(float) if len(n) else np.zeros((0, N_FEATURES))
    return Measured(counts, features, (last - first), line_bounds, line_hash, dup)


@dataclass
class Chain:
    """Weights of a linear chain of two labels: 0 boilerplate, 1 content."""

    emit: np.ndarray  # features: score of label 1 over label 0
    move: np.ndarray  # from label, to label

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The most probable labels (Viterbi); on a tie content."""
        if not len(features):
            return np.zeros(0, np.int8)
        score = (features @ self.emit).tolist()
        (stay0, up), (down, stay1) = self.move.tolist()
        lead, back = score[0], []  # lead: best score that ends in 1, less the best that ends in 0
        for s in score[1:]:
            to0, to1 = lead + down > stay0, lead + stay1 >= up
            back.append((to0, to1))
            lead = s + (lead + stay1 if to1 else up) - (lead + down if to0 else stay0)
        label = lead >= 0
        out = [label]
        for to0, to1 in reversed(back):
            label = to1 if label else to0
            out.append(label)
        return np.array(out[::-1], np.int8)


def fit(sequences: list[tuple[np.ndarray, np.ndarray, int]], steps: int = 400, rate: float = 0.08, penalty: float = 1e-3) -> Chain | None:
    """Maximum likelihood by forward-backward and Adam; None unless both labels occur. sequences: features of lines, their labels, the document's."""
    sequences = [x for x in sequences if len(x[0])]
    if len({y for _, _, y in sequences}) < 2:
        return None
    parts = [(x[k : k + PIECE], g[k : k + PIECE], y) for x, g, y in sequences for k in range(0, len(x), PIECE)]
    n, f = len(parts), N_FEATURES
    x, mask, gold = np.zeros((n, PIECE, f)), np.zeros((n, PIECE), bool), np.zeros((n, PIECE), int)
    for i, (a, g, _) in enumerate(parts):
        x[i, : len(a)], mask[i, : len(a)], gold[i, : len(a)] = a, True, g
    weight = np.full(n, 1 / n)  # kinds of documents weigh as often as they occur: content is the usual label
    both = mask[:, 1:]
    seen = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum(1) @ weight for b in (0, 1)] for a in (0, 1)])
    theta, m, v = np.zeros(f + 4), np.zeros(f + 4), np.zeros(f + 4)
    for t in range(1, steps + 1):
        emit, move = theta[:f], theta[f:].reshape(2, 2)
        e = np.stack([np.zeros((n, PIECE)), x @ emit], axis=2)
        alpha, beta = np.zeros((n, PIECE, 2)), np.zeros((n, PIECE, 2))
        alpha[:, 0] = e[:, 0]
        for k in range(1, PIECE):
            step = np.logaddexp(alpha[:, k - 1, 0, None] + move[0], alpha[:, k - 1, 1, None] + move[1]) + e[:, k]
            alpha[:, k] = np.where(mask[:, k, None], step, alpha[:, k - 1])
        for k in range(PIECE - 2, -1, -1):
            ahead = e[:, k + 1] + beta[:, k + 1]
            step = np.logaddexp(move[:, 0] + ahead[:, 0, None], move[:, 1] + ahead[:, 1, None])
            beta[:, k] = np.where(mask[:, k + 1, None], step, 0)
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p1 = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None]) * mask
        grad = np.zeros(f + 4)
        grad[:f] = np.tensordot((gold * mask - p1) * weight[:, None], x, axes=([0, 1], [0, 1]))
        pair = np.exp(alpha[:, :-1, :, None] + move + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[:, :, None, None]
        grad[f:] = (seen - np.tensordot(weight, pair.sum(1), axes=(0, 0))).ravel()
        grad -= penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Chain(theta[:f], theta[f:].reshape(2, 2))


#: Of each training line beside its features: its hash, and whether it repeats an earlier one.
_BESIDE = 2


def line_labels(documents: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """Of each document (what stands beside its lines' features, quality): 1 for content lines, 0 for boilerplate.

    A document is known by the least of its other lines' hashes: near copies mostly agree in it, unrelated ones don't.
    """
    company: dict[int, list[int]] = {}
    for beside, _ in documents:
        lines = sorted({(int(k), line) for k, line in zip(mix(beside[:, 0].view(np.uint64).copy()), beside[:, 0].tolist(), strict=True)})
        for k, (_, line) in enumerate(lines):
            company.setdefault(line, []).append(lines[1 if k == 0 else 0][1] if len(lines) > 1 else line)
    recurs = {line for line, others in company.items() if len(set(others)) >= max(RECUR, UNRELATED * len(others))}
    return [np.array([int(quality == 1 and not dup and line not in recurs) for line, dup in beside.tolist()], int) for beside, quality in documents]


def _pieces(m: Measured, a: int, b: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features, and what stands beside them, of at most `most` pieces of the lines a to b."""
    beside = np.stack([m.line_hash[a:b].view(np.int64), m.line_dup[a:b].astype(np.int64)], axis=1)
    starts = np.arange(0, b - a, PIECE)
    rank = np.argsort(mix(beside[starts, 0].view(np.uint64) + starts.astype(np.uint64)), kind="stable")[:most]
    for k in np.sort(starts[rank]):
        yield m.features[a + k : min(b, a + k + PIECE)], beside[k : k + PIECE]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, train_pieces: int = TRAIN_PIECES) -> Chain | None:
    """Fits the chain on the train_docs labelled documents whose ids hash lowest, and train_pieces pieces of each."""
    prepare(docs.sparkSession)
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.min(F.col("quality").cast("int")).alias("quality")).orderBy(F.xxhash64("id"), "id").limit(train_docs)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")  # train_docs rows at most

    @lean
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, quality = column(batch, "text"), batch.column(2).to_pylist()
            out: list[tuple[int, bytes, bytes]] = []
            for lo, hi in slices(texts):
                m = measure(texts.slice(lo, hi - lo))
                for k, (a, b) in enumerate(zip(m.line_bounds[:-1], m.line_bounds[1:], strict=True)):
                    out += [(quality[lo + k], x.tobytes(), y.tobytes()) for x, y in _pieces(m, a, b, train_pieces)]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["quality", "lines", "beside"])

    got = rows.select("id", "text", "quality").mapInArrow(lines, "quality int, lines binary, beside binary").collect()  # train_docs x train_pieces x PIECE lines at most
    got.sort(key=lambda r: (r["quality"], bytes(r["lines"]), bytes(r["beside"])))
    beside = [(np.frombuffer(r["beside"], np.int64).reshape(-1, _BESIDE), r["quality"]) for r in got]
    return fit([(np.frombuffer(r["lines"], float).reshape(-1, N_FEATURES), g, r["quality"]) for r, g in zip(got, line_labels(beside), strict=True)])


def judge(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share (null without lines), n_lines, n_boilerplate_lines."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    @lean
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_verdicts(column(batch, "text"), chain, share)], ["id", *_NAMES])

    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return base.mapInArrow(judged, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_lines long, n_boilerplate_lines long").withColumnRenamed("id", id_col)


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "n_lines", "n_boilerplate_lines"]


def _verdicts(texts: pa.Array, chain: Chain | None, share: float) -> list[pa.Array]:
    counts, shares, lines = [np.zeros((0, 5), np.int64)], [], []
    for lo, hi in slices(texts):
        m = measure(texts.slice(lo, hi - lo))
        counts.append(m.counts)
        for a, b in zip(m.line_bounds[:-1], m.line_bounds[1:], strict=True):
            words = m.line_words[a:b]
            label = chain.decode(m.features[a:b]) if chain else np.ones(b - a, np.int8)
            shares.append(float(words[label == 1].sum() / words.sum()) if b > a else None)
            lines.append((b - a, int((label == 0).sum())))
    c = np.concatenate(counts)
    failed = (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > 50 * c[:, 0])
    kept = [not f and s is not None and s >= share for f, s in zip(failed, shares, strict=True)]
    return [*(pa.array(c[:, k].astype(np.int64)) for k in range(5)), pa.array(failed), pa.array(kept, pa.bool_()), pa.array(shares, pa.float64()), pa.array([n for n, _ in lines], pa.int64()), pa.array([n for _, n in lines], pa.int64())]


def filter_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns: one pass over rows, in which each row is judged beside its own columns."""
    chain = train(docs, labels, id_col, text_col)
    place, width = docs.columns.index(text_col), len(docs.columns)

    @lean
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            if not (pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type)):
                texts = batch.column(width)  # the text as a string, beside it
            verdicts = _verdicts(texts.fill_null("") if texts.null_count else texts, chain, CONTENT_SHARE)
            yield batch.select(list(range(width))).filter(verdicts[6])

    said = docs
    if not isinstance(docs.schema[text_col].dataType, StringType):
        said = docs.select("*", F.col(text_col).cast("string").alias(unlike(docs.columns, "said")))
    return said.mapInArrow(kept, docs.schema)
