"""Language-model scores from a hashed maximum-entropy model.

The probability of a word is factored over word classes. The class given the two words before it is
a softmax over hashed features (previous word, previous two words, and the word before last alone, a
skip feature); the word given its class is a maximum-entropy model with one feature a word, whose
optimum is its smoothed share of the class. Classes are ranges of word frequency of about equal
mass, cut by hash, so a word's class follows from its count alone.

Nothing that grows with the vocabulary is broadcast. Texts are tokenised once, in batches that carry
their own word list; word lists are joined with the counts of the whole training part and brought
back to their batch, which then becomes class numbers and 16-bit word codes. Training and scoring
read those. A round of training sums the gradient, the expected less the observed counts of each
feature and class, over all training documents at the round's weights, and moves the weights along it
as far as raises a lower bound of the likelihood most. Probabilities enter the sums as whole multiples
of 2**-16, so sums are exact and the model is a function of the documents alone, not of how they lie
in files and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlens.llm.text import LOWER, WordHasher, mix64, signed
from playerlens.session import cut_lineage

BATCH_BYTES = 10 << 20
#: The hash that stands for the end of a text.
END = 0x5851F42D4C957F2D
_BUCKETS = 4  # of word counts, for each power of two
_ROWS = 64  # parts of the weight table
_FEATURES = 3
_UNIT = 1 << 16  # what a probability of one counts in a sum


def _pack(x: np.ndarray) -> bytes:
    """Compressed little-endian numbers, equal bytes side by side."""
    flat = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T
    return zstandard.ZstdCompressor(level=1).compress(flat.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(width, -1).T).view(kind).ravel()


_TOKENISED = pa.schema(
    {
        "batch": pa.int64(),
        "hash": pa.int64(),
        "n": pa.int64(),
        "doc_id": pa.list_(pa.int64()),
        "held_out": pa.list_(pa.bool_()),
        "sizes": pa.list_(pa.int64()),
        "tokens": pa.binary(),
    }
)
_TOKENISED_SQL = (
    "batch long, hash long, n long, doc_id array<long>, held_out array<boolean>, "
    "sizes array<long>, tokens binary"
)


def _rows(schema: pa.Schema, length: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _tokenise(batch_bytes: int):
    def flush(number, ids, held, parts) -> Iterator[pa.RecordBatch]:
        sizes = [len(p) for p in parts]
        hashes = np.concatenate(parts)
        words, local = np.unique(hashes, return_inverse=True)
        train = np.repeat(~np.array(held, bool), sizes)
        n = np.bincount(local[train], minlength=len(words))
        # Named by its place: the batches are read from the table this is written to.
        place = f"{TaskContext.get().partitionId()}:{number}".encode()
        batch = xxhash.xxh64_intdigest(place) - (1 << 63)
        for i in range(0, len(words), 1 << 16):
            some = signed(words[i : i + (1 << 16)])
            many = np.full(len(some), batch, np.int64)
            yield _rows(_TOKENISED, len(some), batch=many, hash=some, n=n[i : i + (1 << 16)])
        yield _rows(
            _TOKENISED,
            1,
            batch=[batch],
            doc_id=[ids],
            held_out=[held],
            sizes=[sizes],
            tokens=[_pack(local.astype(np.uint32))],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(LOWER)
        end = np.array([END], np.uint64)
        ids, held, parts, size, number = [], [], [], 0, 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                for doc_id, text, out, words in zip(
                    part.column(0).to_pylist(),
                    texts,
                    part.column(2).to_pylist(),
                    hasher.many(texts),
                    strict=True,
                ):
                    ids.append(doc_id)
                    held.append(out)
                    parts.append(np.concatenate([words, end]))
                    size += len(text or b"") + 1
                    if size >= batch_bytes:
                        yield from flush(number, ids, held, parts)
                        ids, held, parts, size, number = [], [], [], 0, number + 1
        if ids:
            yield from flush(number, ids, held, parts)

    return run


@dataclass
class Classes:
    """Word classes by count, their masses, and the totals of the training part."""

    first: np.ndarray
    count: np.ndarray
    n_tokens: int
    n_words: int
    mass: np.ndarray = None

    def __len__(self) -> int:
        return int((self.first + self.count).max())

    def of(self, counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        bucket = np.zeros(len(counts), np.int64)
        known = counts > 0
        bucket[known] = np.floor(np.log2(counts[known]) * _BUCKETS + 1e-9).astype(np.int64)
        bucket = np.minimum(bucket, len(self.first) - 1)
        part = (mix64(hashes) >> np.uint64(20)) % self.count[bucket].astype(np.uint64)
        return np.where(known, self.first[bucket] + part.astype(np.int64), self.first[0])


def word_classes(counts: DataFrame, classes: int) -> Classes:
    """Classes of about equal mass from ``hash, c``; what reaches the driver is a few hundred rows."""
    bucket = F.floor(F.log2("c") * _BUCKETS + 1e-9)
    by = counts.groupBy(bucket.alias("b")).agg(F.sum("c").alias("mass"), F.count("*").alias("words"))
    rows = {r["b"]: (r["mass"], r["words"]) for r in by.collect()}
    top = max(rows, default=0)
    n_tokens = sum(m for m, _ in rows.values())
    first, count = np.zeros(top + 1, np.int64), np.ones(top + 1, np.int64)
    share, filled, at = max(1.0, n_tokens / classes), 0.0, 0
    for b in range(top, -1, -1):
        mass, words = rows.get(b, (0, 0))
        if mass >= share:
            at += filled > 0
            parts = min(int(round(mass / share)), words)
            first[b], count[b], filled = at, parts, 0.0
            at += parts
        else:
            first[b] = at
            filled += mass
            if filled >= share:
                at, filled = at + 1, 0.0
    # Frequent words come first; the last class has the rare and the unknown ones.
    return Classes(first, count, n_tokens, sum(w for _, w in rows.values()))


def _encode(classes: Classes, mass: np.ndarray):
    schema = pa.schema(
        {
            "doc_id": pa.int64(),
            "held_out": pa.bool_(),
            "n_tokens": pa.int64(),
            "n_known": pa.int64(),
            "base_score": pa.float64(),
            "in_class": pa.float64(),
            "classes": pa.binary(),
            "codes": pa.binary(),
        }
    )
    total = classes.n_tokens + classes.n_words + 1

    def run(words: pa.Table, docs: pa.Table) -> pa.Table:
        h = words.column("hash").to_numpy().view(np.uint64)
        c = words.column("c").to_numpy()
        order = np.argsort(h)  # the order of the batch's word list
        h, c = h[order], c[order]
        of_word = classes.of(c, h)
        base = np.log10((c + 1) / total)
        inside = np.log10((c + 1) / mass[of_word])
        code = (mix64(h + np.uint64(1)) >> np.uint64(48)).astype(np.uint16)
        of_word = of_word.astype(np.uint8 if len(classes) <= 256 else np.uint16)
        out = []
        for row in docs.to_pylist():
            local = _unpack(row["tokens"], np.uint32)
            some = np.split(local, np.cumsum(row["sizes"])[:-1])
            out.append(
                pa.Table.from_arrays(
                    [
                        pa.array(row["doc_id"], pa.int64()),
                        pa.array(row["held_out"], pa.bool_()),
                        pa.array(row["sizes"], pa.int64()),
                        pa.array([int((c[x] > 0).sum()) for x in some], pa.int64()),
                        pa.array([float(base[x].sum()) for x in some], pa.float64()),
                        pa.array([float(inside[x].sum()) for x in some], pa.float64()),
                        pa.array([of_word[x].tobytes() for x in some], pa.binary()),
                        pa.array([code[x].tobytes() for x in some], pa.binary()),
                    ],
                    schema=schema,
                )
            )
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


_ENCODED_SQL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
    "in_class double, classes binary, codes binary"
)


def encoded(docs: DataFrame, held_out, *, classes: int, batch_bytes: int) -> tuple[DataFrame, Classes]:
    """Every document as class numbers and word codes, with the parts of its score that need counts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    made = cut_lineage(rows.mapInArrow(_tokenise(batch_bytes), _TOKENISED_SQL))
    words = made.filter("tokens IS NULL").select("batch", "hash", "n")
    counts = cut_lineage(
        words.filter("n > 0").groupBy("hash").agg(F.sum("n").alias("c"))
    )
    known = word_classes(counts, classes)
    mass = np.zeros(len(known))
    for row in counts.mapInArrow(_masses(known), "k long, m long").groupBy("k").agg(F.sum("m").alias("m")).collect():
        mass[row["k"]] = row["m"]
    unknown = known.of(np.zeros(1, np.int64), np.zeros(1, np.uint64))[0]
    mass[unknown] += 1  # all unknown words together are one more word
    known.mass = mass
    joined = words.join(counts, "hash", "left").select(
        "batch", "hash", F.coalesce("c", F.lit(0)).alias("c")
    )
    # A group is one batch: its words and its one row of texts, bounded by ``batch_bytes``.
    texts = made.filter("tokens IS NOT NULL").drop("hash", "n")
    texts = texts.withColumnRenamed("batch", "of")
    rows = (
        joined.groupBy("batch")
        .cogroup(texts.groupBy("of"))
        .applyInArrow(_encode(known, mass), _ENCODED_SQL)
    )
    return cut_lineage(rows), known


def _masses(classes: Classes):
    schema = pa.schema({"k": pa.int64(), "m": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column(1).to_numpy()
            k = classes.of(c, batch.column(0).to_numpy().view(np.uint64))
            sums = np.bincount(k, weights=c + 1, minlength=len(classes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(classes))), pa.array(sums.astype(np.int64))], schema=schema
            )

    return run


def feature_rows(codes: np.ndarray, bits: int) -> np.ndarray:
    """Rows of the weight table for each word's three features, from the words before it."""
    before = np.concatenate([np.zeros(2, np.uint64), codes[:-1].astype(np.uint64) + np.uint64(1)])
    one, two = before[1:], before[:-1]
    shift = np.uint64(64 - bits)
    keys = [one, one << np.uint64(20) | two, two]
    return np.stack(
        [mix64(k * np.uint64(3) + np.uint64(i)) >> shift for i, k in enumerate(keys)], axis=1
    ).astype(np.int64)


def class_probabilities(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = weights[rows[:, 0]] + weights[rows[:, 1]] + weights[rows[:, 2]] + bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _numbers(classes: pa.BinaryScalar, codes: pa.BinaryScalar) -> tuple[np.ndarray, np.ndarray]:
    """Class numbers, in one byte or two, and word codes of a document."""
    code = np.frombuffer(codes.as_buffer(), np.uint16)
    kinds = classes.as_buffer()
    return np.frombuffer(kinds, np.uint8 if kinds.size == len(code) else np.uint16), code


def _steps(batches: Iterator[pa.RecordBatch], bits: int, step: int):
    """Feature rows and classes of the documents of all batches, ``step`` words at a time."""
    rows, classes, n = [], [], 0
    for batch in batches:
        for k, c in zip(batch.column(0), batch.column(1), strict=True):
            kinds, codes = _numbers(k, c)
            found = feature_rows(codes, bits)
            for i in range(0, len(kinds), step):
                rows.append(found[i : i + step])
                classes.append(kinds[i : i + step])
                n += len(rows[-1])
                if n >= step:
                    yield np.concatenate(rows), np.concatenate(classes)
                    rows, classes, n = [], [], 0
    if rows:
        yield np.concatenate(rows), np.concatenate(classes)


_SUMS = pa.schema({"part": pa.int32(), "sums": pa.binary()})
_SUMS_SQL = "part int, sums binary"


def _counted(weights: np.ndarray | None, bias: np.ndarray, bits: int, step: int):
    """Counts of each feature and class: expected at these weights, or observed without weights."""
    n, many = 1 << bits, len(bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((many, n))  # whole numbers, exact up to 2**37 words a task
        found = False
        for rows, kinds in _steps(batches, bits, step):
            found = True
            features = rows.T.ravel()
            if weights is None:
                cells = np.tile(kinds.astype(np.int64) * n, _FEATURES) + features
                sums += _UNIT * np.bincount(cells, minlength=many * n).reshape(many, n)
                continue
            p = class_probabilities(weights, bias, rows)
            p *= _UNIT
            units = np.rint(p, out=p).T.astype(np.float64)
            for k in range(many):
                sums[k] += np.bincount(features, np.tile(units[k], _FEATURES), n)
        if found:
            size = -(-n // _ROWS)
            whole = sums.T.astype(np.int64)
            parts = [_pack(whole[i * size : (i + 1) * size].ravel()) for i in range(_ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_ROWS), pa.int32()), pa.array(parts, pa.binary())], schema=_SUMS
            )

    return run


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each part of the table, streamed; a task holds one sum a part."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            new = _unpack(packed, np.int64)
            sums[part] = sums[part] + new if part in sums else new
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([_pack(x) for x in sums.values()], pa.binary())],
        schema=_SUMS,
    )


def _counts(
    corpus: DataFrame, weights: np.ndarray | None, bias: np.ndarray, bits: int, step: int
) -> np.ndarray:
    parts = corpus.mapInArrow(_counted(weights, bias, bits, step), _SUMS_SQL)
    # Summed first in sixteen groups of tasks, then once more.
    salted = parts.repartition("part", F.pmod(F.xxhash64("sums"), F.lit(16)))
    sums = salted.mapInArrow(_sum_parts, _SUMS_SQL).repartition("part")
    counts = np.zeros((1 << bits, len(bias)))
    size = -(-len(counts) // _ROWS)
    for row in sums.mapInArrow(_sum_parts, _SUMS_SQL).collect():  # the size of the weight table
        at = slice(row["part"] * size, (row["part"] + 1) * size)
        counts[at] = _unpack(row["sums"], np.int64).reshape(-1, len(bias)) / _UNIT
    return counts


def train(
    corpus: DataFrame,
    known: Classes,
    *,
    bits: int,
    rounds: int,
    step: int,
    rate: float,
    prior: float = 16.0,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias; every round uses every training document.

    Weights have a log-gamma prior that stands for ``prior`` more words with classes at their shares,
    which keeps those of rare features near zero. ``rate`` multiplies the step that is best for the
    bound; up to 1 every round gains, and below 2 it still does near the optimum.
    """
    share = known.mass / known.mass.sum()
    bias = np.log(np.maximum(share, 1e-12)).astype(np.float32)
    weights = np.zeros((1 << bits, len(known)), np.float32)
    mine = corpus.filter(~F.col("held_out")).select("classes", "codes")
    pseudo = prior * np.maximum(share, 1e-12)
    observed = _counts(mine, None, bias, bits, step) + pseudo
    for _ in range(rounds):
        expected = _counts(mine, weights, bias, bits, step) + pseudo * _odds(weights)
        weights += (rate / _FEATURES * np.log(observed / expected)).astype(np.float32)
    return weights, bias


def _odds(weights: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(weights, -30, 30))


def _score(weights: np.ndarray, bias: np.ndarray, bits: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            classes, codes = (batch.column(names.index(n)) for n in ("classes", "codes"))
            found = []
            for k, c in zip(classes, codes, strict=True):
                kinds, code = _numbers(k, c)
                rows = feature_rows(code, bits)
                total = 0.0
                for i in range(0, len(kinds), step):
                    p = class_probabilities(weights, bias, rows[i : i + step])
                    got = p[np.arange(len(p)), kinds[i : i + step]].astype(np.float64)
                    total += float(np.log10(np.maximum(got, 1e-30)).sum())
                found.append(total)
            keep = [i for i, n in enumerate(names) if n not in ("classes", "codes")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(found, pa.float64())],
                names=[*(names[i] for i in keep), "of_class"],
            )

    return run


def score(
    docs: DataFrame,
    held_out,
    *,
    classes: int = 32,
    bits: int = 14,
    rounds: int = 2,
    step: int = 16_384,
    rate: float = 1.6,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    ``held_out`` is a boolean column: such rows are scored but not learned from. Words are what
    stands between ASCII white space, A-Z in lower case; each text ends with one more token. A null
    or empty text is that token alone. Without training rows every token is unknown and both scores
    are 0 (probability 1). ``score`` is the model's log10 probability, ``base_score`` that of
    add-one-smoothed word counts. Both depend on the rows alone, not on their order or partitions.
    """
    corpus, known = encoded(docs, held_out, classes=classes, batch_bytes=batch_bytes)
    weights, bias = train(corpus, known, bits=bits, rounds=rounds, step=step, rate=rate)
    scored = corpus.mapInArrow(
        _score(weights, bias, bits, step),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "in_class double, of_class double",
    )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("in_class") + F.col("of_class")).alias("score"),
    )
