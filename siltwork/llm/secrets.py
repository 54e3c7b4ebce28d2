"""Secrets in documents: values given to key words and long tokens, and a random forest that removes the false ones."""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.llm import words as W
from siltwork.llm.folds import bounded, held_out
from siltwork.shared import shared_path, write_shared

SAMPLE_FINDINGS = 20_000
TREES, DEPTH, SEED = 40, 6, 7
LEAST, LONG = 8, 20
NEAR = 48  # bytes looked at on either side

TOKEN = np.zeros(256, bool)
TOKEN[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *map(ord, "+/_-")]] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
SIGN = np.zeros(256, bool)
SIGN[[ord("="), ord(":")]] = True
ALPHABET = 128
TRIGRAMS = 27**3

# Words that stand by secrets, and by what only looks like one.
KEY_WORDS = "password passwd pwd secret token key apikey api_key access_key auth credential credentials bearer private".split()
SAMPLE_WORDS = "example sample dummy test fake placeholder changeme mock redacted card phone order invoice".split()
SAMPLE_PATHS = "test example sample mock fixture doc".split()

FEATURES = [
    "length", "digits", "uppers", "lowers", "hex", "variety", "transitions", "switches", "dictionary",
    "path_depth", "path_sample", "assigned", "quoted", "key_word", "sample_word", "words_before", "words_after",
]
SCHEMA = "array<struct<start:bigint,value:string," + ",".join(f"{f}:double" for f in FEATURES) + ">>"
ASSIGN = re.compile(rb"[=:]\s*[\"']?$")
KEYED = re.compile((r"(?:" + "|".join(KEY_WORDS) + r")[\w-]*\s*[=:]?\s*[\"']?$").encode(), re.I)
SAMPLED = re.compile((r"\b(?:" + "|".join(SAMPLE_WORDS) + r")").encode(), re.I)
PLAIN_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")
VALUE = re.compile(rb"[=:][ \t]{0,3}(?=\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"']+))")  # looks ahead only, so that values may hold others
CLOSING = b".,;)]}"


def _letters(raw: np.ndarray) -> np.ndarray:
    """1 to 26 for ASCII letters, else 0."""
    low = W.LOWER[raw].astype(np.int64) - ord("a") + 1
    return np.where((low >= 1) & (low <= 26), low, 0)


def _count_corpus(batches):
    """Rows (kind, cell, n): pairs of characters, and trigrams of letters, summed over a task."""
    pairs, trigrams = np.zeros(ALPHABET * ALPHABET, np.int64), np.zeros(TRIGRAMS, np.int64)
    for batch in batches:
        for _, raw, _ in W.text_chunks(batch.column(0)):
            if len(raw) < 3:
                continue
            low = np.minimum(W.LOWER[raw], ALPHABET - 1).astype(np.int64)
            pairs += np.bincount(low[:-1] * ALPHABET + low[1:], minlength=len(pairs))
            letter = _letters(raw)
            inside = (letter[:-2] > 0) & (letter[1:-1] > 0) & (letter[2:] > 0)
            trigrams += np.bincount((letter[:-2] * 729 + letter[1:-1] * 27 + letter[2:])[inside], minlength=TRIGRAMS)[:TRIGRAMS]
    for kind, counts in (("pair", pairs), ("trigram", trigrams)):
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([kind] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], ["kind", "cell", "n"])


def corpus_model(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each character after another, and the trigrams words are made of.

    Counted over all texts; its size is that of the alphabet, whatever the input.
    A trigram is in the dictionary from a 20th of an even share of all trigrams.
    """
    counted = docs.select(text_col).mapInArrow(_count_corpus, "kind string, cell bigint, n bigint")
    rows = counted.groupBy("kind", "cell").agg(F.sum("n").alias("n")).toArrow().to_pylist()
    pairs, trigrams = np.full(ALPHABET * ALPHABET, 0.5), np.zeros(TRIGRAMS)
    for r in rows:
        (pairs if r["kind"] == "pair" else trigrams)[r["cell"]] += r["n"]
    pairs = pairs.reshape(ALPHABET, ALPHABET)
    common = trigrams > max(1.0, trigrams.sum() / TRIGRAMS / 20)
    return np.log(pairs / pairs.sum(1, keepdims=True)), common


def given_values(text: bytes) -> list[tuple[int, int]]:
    """Spans of values that a key word is given: all between quotes, else all up to white space or a quote."""
    found = []
    for match in VALUE.finditer(text):
        which = match.lastindex
        start, end = match.span(which)
        if which == 3:
            end = start + len(text[start:end].rstrip(CLOSING))
        if end > start and (not found or start >= found[-1][1]) and KEYED.search(text[max(0, start - NEAR) : start]):
            found.append((start, end))
    return found


def _features(text: bytes, start: int, end: int, source: str, pairs: np.ndarray, common: np.ndarray) -> dict:
    value = np.frombuffer(text[start:end], np.uint8)
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    n = len(value)
    digit = DIGIT[value]
    upper = (value >= 65) & (value <= 90)
    lower = (value >= 97) & (value <= 122)
    low = np.minimum(W.LOWER[value], ALPHABET - 1).astype(np.int64)
    kind = digit * 1 + upper * 2 + lower * 3
    letter = _letters(value)
    inside = (letter[:-2] > 0) & (letter[1:-1] > 0) & (letter[2:] > 0)
    cells = (letter[:-2] * 729 + letter[1:-1] * 27 + letter[2:])[inside]
    path = source.lower()
    return {
        "start": start,
        "value": text[start:end].decode(),
        "length": float(n),
        "digits": float(digit.mean()),
        "uppers": float(upper.mean()),
        "lowers": float(lower.mean()),
        "hex": float((digit | ((low >= 97) & (low <= 102))).mean()),
        "variety": len(np.unique(value)) / min(n, 62),
        "transitions": float(pairs[low[:-1], low[1:]].mean()) if n > 1 else 0.0,
        "switches": float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0,
        "dictionary": float(common[cells].sum() / max(n - 2, 1)),
        "path_depth": float(path.count("/")),
        "path_sample": float(any(w in path for w in SAMPLE_PATHS)),
        "assigned": float(ASSIGN.search(before) is not None),
        "quoted": float(before[-1:] in (b'"', b"'") and after[:1] in (b'"', b"'")),
        "key_word": float(KEYED.search(before) is not None),
        "sample_word": float(SAMPLED.search(before + b" " + after) is not None),
        "words_before": float(len(PLAIN_WORD.findall(before))),
        "words_after": float(len(PLAIN_WORD.findall(after))),
    }


def findings_of(pairs: np.ndarray, common: np.ndarray):
    """Column function: text and source to candidate tokens with their features.

    A candidate is the whole value that a key word is given, whatever its length and characters; else a run of
    letters, digits and ``+/_-`` of at least ``LEAST`` bytes with a digit and a letter, or after an
    assignment; or of 12 digits; or of ``LONG`` bytes.
    """

    @F.arrow_udf(SCHEMA)
    def findings(texts: pa.Array, sources: pa.Array) -> pa.Array:
        names = ["start", "value", *FEATURES]
        columns: dict[str, list] = {name: [] for name in names}
        lengths = [0]
        for first, raw, offsets in W.text_chunks(texts):
            starts, ends, runs = W.runs(TOKEN[raw], offsets)
            size = ends - starts
            digits = np.concatenate([[0], np.cumsum(DIGIT[raw])])
            digits = digits[ends] - digits[starts]
            letters = np.concatenate([[0], np.cumsum(W.LETTER[raw])])
            letters = letters[ends] - letters[starts]
            last = raw[np.maximum(starts - 1, 0)] if len(raw) else starts
            quoted = (last == 0x22) | (last == 0x27)
            before = np.where(quoted, raw[np.maximum(starts - 2, 0)], last) if len(raw) else last
            spaced = before == 0x20
            before = np.where(spaced, raw[np.maximum(starts - 2 - quoted, 0)], before) if len(raw) else before
            given = (starts > 0) & ((before == 0x3D) | (before == 0x3A))
            good = (size >= LEAST) & (((digits > 0) & (letters > 0)) | given | (size >= LONG) | ((digits >= 12) & (letters == 0)))
            picked = np.flatnonzero(good)
            bounds = np.searchsorted(picked, runs)
            assigns = np.concatenate([[0], np.cumsum(SIGN[raw], dtype=np.int64)])[offsets]
            per_row = []
            for row in range(len(offsets) - 1):
                own = picked[bounds[row] : bounds[row + 1]]
                if not len(own) and assigns[row] == assigns[row + 1]:
                    per_row.append(0)
                    continue
                text = raw[offsets[row] : offsets[row + 1]].tobytes()
                source = sources[first + row].as_py() or ""
                given = given_values(text)
                begins, stops = [*(a for a, _ in given), len(text)], [b for _, b in given]
                tokens = [(int(starts[i] - offsets[row]), int(ends[i] - offsets[row])) for i in own]
                spans = sorted([*given, *((a, b) for a, b in tokens if begins[bisect_right(stops, a)] >= b)])  # outside given values
                for start, end in spans:
                    found = _features(text, start, end, source, pairs, common)
                    for name in names:
                        columns[name].append(found[name])
                per_row.append(len(spans))
            lengths.extend(per_row)
        kinds = [pa.int64(), pa.string(), *[pa.float64()] * len(FEATURES)]
        inner = pa.StructArray.from_arrays([pa.array(columns[n], k) for n, k in zip(names, kinds)], names)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths).astype(np.int32)), inner)

    return findings


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """A row for each candidate: ``doc_id``, ``start`` (byte), ``value`` and its features."""
    pairs, common = corpus_model(docs, text_col)
    found = findings_of(pairs, common)(F.col(text_col), F.col(path_col).cast("string"))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("f")).select("doc_id", "f.*")


def known_findings(found: DataFrame) -> DataFrame:
    """Findings whose kind is plain from their format, labelled 1 or 0; the rest have no label.

    Access keys with a fixed lead and hexadecimal values given to a key word are secrets; bare
    numbers, plain long words and values by sample words are not.
    """
    value = F.col("value")
    secret = value.rlike("^AKIA[0-9A-Z]{16}$") | (value.rlike("^[0-9a-f]{12,}$") & (F.col("key_word") == 1) & (F.col("assigned") == 1))
    no_secret = value.rlike("^[0-9-]+$") | value.rlike("^[A-Za-z]+$") | (F.col("sample_word") == 1)
    return found.withColumn("label", F.when(secret, 1.0).when(no_secret, 0.0)).where("label IS NOT NULL")


def secret_scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    sample_findings: int = SAMPLE_FINDINGS,
    threshold: float = 0.5,
) -> DataFrame:
    """All candidates: ``doc_id``, ``start``, ``length``, ``held_out``, ``score``, ``is_secret``.

    The forest learns from ``labelled`` findings (``doc_id``, ``start``, ``label``), or else
    from findings that their format labels; of both only those of documents not held out, and
    ``sample_findings`` of them at most.  The value, id and label are no features.

    Null and empty texts have no findings; a null path counts as empty.  Where
    only one class is labelled nothing can be removed: every candidate is
    reported with score 1.  Repeated rows give their findings each; a null id stays null.
    Extra columns are not read.
    """
    found = write_shared(candidates(docs, id_col, text_col, path_col), "findings")
    if labelled is None:
        known = known_findings(found)
    else:
        marks = labelled.select(F.col("doc_id").alias("_doc"), F.col("start").alias("_start"), F.col("label").cast("double").alias("label"))
        known = found.join(marks.dropna(), (F.col("doc_id") == F.col("_doc")) & (F.col("start") == F.col("_start")))
    known = known.where(~held_out("doc_id"))
    sample = write_shared(bounded(known, F.struct("doc_id", "start"), sample_findings).select("label", *FEATURES), "labelled")
    shown: Column
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    if sample.select("label").distinct().count() == 2:
        forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
        # Read back from the shared folder: a freshly fitted model holds its training summary and by it the session,
        # which cannot be sent to executors once the session has been observed.
        path = shared_path(docs.sparkSession, "forest")
        forest.fit(assemble.transform(sample)).save(path)
        model = RandomForestClassificationModel.load(path)
        out = model.transform(assemble.transform(found))
        shown = vector_to_array("probability")[1]
    else:
        out, shown = found, F.lit(1.0)
    return out.select(
        "doc_id",
        "start",
        F.length("value").cast("long").alias("length"),
        held_out("doc_id").alias("held_out"),
        shown.alias("score"),
        (shown >= threshold).alias("is_secret"),
    )
