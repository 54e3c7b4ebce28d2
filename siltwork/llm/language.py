"""Language of texts by error-correcting output codes over byte n-grams.

Each language has a codeword.  For each bit of the code a naive Bayes classifier
over n-grams tells the languages with a 1 from those with a 0.  A text's bits
are decoded to the codeword of least loss, each bit weighted by how well it did
on texts its classifier was not fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm import words as W
from siltwork.llm.folds import bounded_distinct, held_out
from siltwork.shared import write_shared

SAMPLE_DOCS = 20_000
ORDERS = (2, 3)
CELLS = 1 << 15
PRIOR = 0.1
UNKNOWN = "und"
TRIALS = 64
NEAR_TIE = 0.9

FOLDED = np.where(W.LETTER, np.arange(256), 0x20).astype(np.uint8)
GRAM_SEEDS = W.seeds(max(ORDERS) + 1, 17)
OUTSIDE = CELLS  # a cell without weight, for n-grams over the end of a text


def codebook(languages: int) -> np.ndarray:
    """Codewords of +1 and -1, a row for each language.

    Up to 7 languages all distinct splits are used; beyond, random codewords
    of 15 bits for each doubling, the draw with the widest least distance.
    """
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= 7:
        splits = np.arange(1, 1 << (languages - 1))
        bits = (splits[None, :] >> np.arange(languages)[:, None]) & 1
    else:
        width = 15 * int(np.ceil(np.log2(languages)))
        best = -1
        for trial in range(TRIALS):
            draw = W.seeds(languages * width, 1000 + trial).reshape(languages, width)
            drawn = ((draw >> np.uint64(40)) & np.uint64(1)).astype(np.int8)
            apart = (drawn[:, None, :] != drawn[None, :, :]).sum(2) + width * np.eye(languages, dtype=int)
            if apart.min() > best:
                best, bits = apart.min(), drawn
        bits = bits[:, (bits.min(0) == 0) & (bits.max(0) == 1)]
    return (2 * bits - 1).astype(np.int8)


def gram_cells(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order, the cell of the n-gram at each folded byte; and the row offsets of those bytes.

    Runs of what is no letter are one blank.
    """
    folded = FOLDED[W.lowered(raw)]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    edges = offsets[:-1][np.diff(offsets) > 0]
    keep[edges] = True
    where = np.concatenate([[0], np.cumsum(keep)])[offsets]
    folded = folded[keep].astype(np.uint64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(where))
    out = []
    for order in ORDERS:
        size = max(len(folded) - order + 1, 0)
        made = np.full(size, GRAM_SEEDS[order], np.uint64)
        for k in range(order):
            made = (made + folded[k : size + k]) * W.STEP
            made ^= made >> np.uint64(29)
        cells = np.full(len(folded), OUTSIDE, np.int32)
        inside = rows[:size] == rows[order - 1 :] if size else np.zeros(0, bool)
        cells[:size][inside] = (made >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int32)[inside]
        out.append(cells)
    return out, where


def _row_sums(values: np.ndarray, where: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[where[1:]] - total[where[:-1]]


def has_letter(texts: pa.Array) -> np.ndarray:
    """Rows with a Unicode letter; only rows with bytes beyond ASCII and no ASCII letter are looked at as text."""
    out = []
    for first, raw, offsets in W.text_chunks(texts):
        ascii_ = np.concatenate([[0], np.cumsum(W.LETTER[raw] & (raw < 0x80))])[offsets]
        beyond = np.concatenate([[0], np.cumsum(raw >= 0x80)])[offsets]
        found = np.diff(ascii_) > 0
        for row in np.flatnonzero(~found & (np.diff(beyond) > 0)):
            found[row] = any(c.isalpha() for c in texts[first + int(row)].as_py())
        out.append(found)
    return np.concatenate(out) if out else np.zeros(0, bool)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x (CELLS + 1)
    scales: np.ndarray  # of a bit's margin, by its usual size
    trust: np.ndarray  # weight of each bit

    @property
    def corrects(self) -> int:
        """Wrong bits that still decode to the right codeword."""
        if len(self.languages) < 2:
            return 0
        apart = (self.codes[:, None, :] != self.codes[None, :, :]).sum(2)
        return int((apart[~np.eye(len(apart), dtype=bool)].min() - 1) // 2)

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Mean log-odds per n-gram of each bit, for each row."""
        out = []
        for _, raw, offsets in W.text_chunks(texts):
            cells, where = gram_cells(raw, offsets)
            grams = np.maximum(np.diff(where), 1)
            chunk = np.zeros((len(offsets) - 1, len(self.weights)))
            for bit, weights in enumerate(self.weights):
                for c in cells:
                    chunk[:, bit] += _row_sums(weights[c], where) / grams
            out.append(chunk)
        return np.concatenate(out) if out else np.zeros((0, len(self.weights)))

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, its probability, and whether another is about as near, for each row."""
        sure = margins * self.scales
        loss = np.stack([(np.logaddexp(0, -sure * code) * self.trust).sum(1) for code in self.codes], axis=1)
        best = loss.argmin(1)
        least = loss[np.arange(len(loss)), best]
        odds = np.exp(least[:, None] - loss)
        score = 1 / odds.sum(1)
        wrong = (np.sign(margins) != self.codes[best]).sum(1)
        return best, score, (score < NEAR_TIE) | (wrong > self.corrects)


def _count_cells(batches):
    """Rows (lang, fold, cell, count), summed over all batches of a task."""
    seen: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        langs, folds = batch.column("lang").to_pylist(), batch.column("fold").to_pylist()
        for first, raw, offsets in W.text_chunks(batch.column("text")):
            cells, where = gram_cells(raw, offsets)
            for row in range(len(offsets) - 1):
                key = langs[first + row], folds[first + row]
                into = seen.setdefault(key, np.zeros(CELLS + 1, np.int64))
                for c in cells:
                    into += np.bincount(c[where[row] : where[row + 1]], minlength=CELLS + 1)
    for (lang, fold), counts in seen.items():
        used = np.flatnonzero(counts[:CELLS])
        columns = [pa.array([lang] * len(used), pa.string()), pa.array([fold] * len(used), pa.int32()), pa.array(used.astype(np.int32)), pa.array(counts[used])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "fold", "cell", "n"])


def _weights(counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Log-odds of each cell for each bit; languages of a side count alike."""
    shares = (counts + PRIOR) / (counts.sum(1, keepdims=True) + PRIOR * CELLS)
    out = np.zeros((codes.shape[1], CELLS + 1))
    for bit in range(codes.shape[1]):
        side = codes[:, bit] > 0
        if side.any() and not side.all():
            out[bit, :CELLS] = np.log(shares[side].mean(0)) - np.log(shares[~side].mean(0))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from rows that are not held out and have a language: from ``sample_docs`` different ones at most.

    Of rows with one text and language one counts, however many there are.
    Two thirds of the sample give the classifiers, the rest the weights of
    the bits.  What reaches the driver is a count for each language and cell,
    and a margin for each row and bit of the sample.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    fold = F.pmod(F.xxhash64(F.col(text_col), F.lit(3)), F.lit(3)).cast("int")
    known = known.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), fold.alias("fold"))
    sample = write_shared(bounded_distinct(known, sample_docs), "sample")
    found = sample.mapInArrow(_count_cells, "lang string, fold int, cell int, n bigint")
    rows = found.groupBy("lang", "fold", "cell").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    if not languages:
        return Model([], codebook(0), np.zeros((1, CELLS + 1)), np.ones(1), np.ones(1))
    at = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((3, len(languages), CELLS))
    of = np.array([at[x] for x in rows.column("lang").to_pylist()])
    counts[rows.column("fold").to_numpy(), of, rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    codes = codebook(len(languages))
    bits = codes.shape[1]
    model = Model(languages, codes, _weights(counts[1:].sum(0), codes), np.ones(bits), np.ones(bits))
    if len(languages) > 1:
        rest = sample.where("fold = 0").select("lang", margins_of(model)("text").alias("m")).toArrow()
        if rest.num_rows:
            margins = np.stack(rest.column("m").to_numpy())
            said = codes[[at.get(x, 0) for x in rest.column("lang").to_pylist()]]
            right = ((margins * said > 0).sum(0) + 1) / (len(margins) + 2)
            model.trust = np.maximum(np.log(right / (1 - right)), 0.1)
            model.scales = 2 / np.maximum(np.median(np.abs(margins), axis=0), 1e-9)
        model.weights = _weights(counts.sum(0), codes)
    return model


def margins_of(model: Model):
    """Column function: text to the margins of the bits."""

    @F.arrow_udf("array<double>")
    def margins(texts: pa.Array) -> pa.Array:
        found = model.margins(texts)
        offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    return margins


def language_of(model: Model, spark):
    """Column function: text to ``lang_pred``, ``score``, ``ambiguous``."""
    shared = spark.sparkContext.broadcast(model)  # CELLS weights for each bit, whatever the input

    @F.arrow_udf("struct<lang_pred:string,score:double,ambiguous:boolean>")
    def language(texts: pa.Array) -> pa.Array:
        model = shared.value
        lettered = has_letter(texts)
        if not model.languages:
            lettered[:] = False
        if len(model.languages) == 1:
            best, score, ambiguous = np.zeros(len(texts), int), np.ones(len(texts)), np.zeros(len(texts), bool)
        elif model.languages:
            best, score, ambiguous = model.decode(model.margins(texts))
        else:
            best, score, ambiguous = np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts), bool)
        names = np.array([*model.languages, UNKNOWN], object)[np.where(lettered, best, -1)]
        columns = [pa.array(names, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(ambiguous | ~lettered)]
        return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "ambiguous"])

    return language


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``ambiguous`` for each row, from its text alone.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is
    every text where nothing was learned.  Ties go to the language first by name.
    Rows without a language or an id are predicted like others; a null id is not held out.
    Repeated rows are predicted each.  Extra columns are not read.
    """
    model = fit(docs, id_col, text_col, lang_col, sample_docs)
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(id_col).alias("held_out"),
        language_of(model, docs.sparkSession)(text_col).alias("said"),
    )
    return found.select("doc_id", "held_out", "said.*")
