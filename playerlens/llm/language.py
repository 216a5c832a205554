"""Language identification by compression.

For every language a zstandard raw-content dictionary is made of labelled texts. A text is cut into
blocks, each block is compressed with every language's dictionary, and the language with the
smallest total wins. Blocks matter: in a long stream the compressor would learn the text itself and
the dictionaries would stop to count. All blocks of a text are used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlens.llm.text import fold, share_of
from playerlens.session import cut_lineage

UNKNOWN = "und"
DICT_BYTES = 96 << 10
BLOCK = 2 << 10
#: Texts from this length on can be rejected for a narrow lead.
MIN_BYTES = 200
#: ASCII letters in lower case, other ASCII as space, longer characters as they are.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)
_ASCII_LETTER = re.compile(rb"[a-z]")


def letters(text: bytes | None) -> bytes:
    """The words of ``text``, A-Z in lower case, one space apart; without a letter nothing."""
    words = b" ".join((text or b"").translate(_LETTERS).split())
    if _ASCII_LETTER.search(words) or any(map(str.isalpha, words.decode(errors="ignore"))):
        return words
    return b""


def drawn(docs: DataFrame, n: int) -> tuple[DataFrame, dict[str, int]]:
    """``lang, text, n``: of each language ``n`` distinct texts, or all, numbered; and its row count.

    Texts are chosen by hash. The share that is kept follows from an estimate of the distinct texts
    of a language, and is enlarged where it leaves too few.
    """
    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    counts = usable.groupBy("lang").agg(F.count("*"), F.approx_count_distinct("h")).collect()
    sizes = {name: rows for name, rows, _ in counts}
    shares = {name: share_of(distinct, n) for name, _, distinct in counts}
    while True:
        one_in = F.lit(1)
        for name, share in shares.items():
            one_in = F.when(F.col("lang") == name, share).otherwise(one_in)
        kept = cut_lineage(usable.filter(F.pmod("h", one_in) == 0).distinct())
        left = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
        short = [k for k, share in shares.items() if share > 1 and left.get(k, 0) < n]
        if not short:
            break
        shares |= {k: shares[k] // 2 for k in short}
    order = Window.partitionBy("lang").orderBy("h", "text")
    numbered = kept.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n)
    return numbered.select("lang", "text", "n"), sizes


def learn(
    docs: DataFrame, *, rows_per_language: int = 400, dict_bytes: int = DICT_BYTES
) -> dict[str, bytes]:
    """A dictionary for each language from ``text, lang`` rows, the most frequent language first.

    The sample is bounded: of each language at most ``rows_per_language`` different texts chosen by
    hash, and of each the part that fits its share of the dictionary twice over. Nothing but this fit
    is sampled. Languages are taken to be few; their counts come to the driver.
    """
    sample, sizes = drawn(docs, rows_per_language)
    return _dictionaries(sample, sizes, rows_per_language, dict_bytes)


def _dictionaries(sample: DataFrame, sizes: dict[str, int], rows: int, dict_bytes: int) -> dict[str, bytes]:
    start = F.substring("text", 1, 2 * dict_bytes // rows)
    parts: dict[str, list[str]] = {}
    for row in sorted(sample.select("lang", "n", start.alias("text")).collect()):
        parts.setdefault(row["lang"], []).append(row["text"])
    names = sorted(parts, key=lambda k: (-sizes[k], k))
    return {k: letters("\n".join(parts[k]).encode())[:dict_bytes] for k in names}


def learn_with_leads(
    docs: DataFrame, *, rows_per_language: int = 400, dict_bytes: int = DICT_BYTES, quantile: float = 0.01, level: int = 6
) -> tuple[dict[str, bytes], dict[str, float]]:
    """The dictionaries of ``learn`` and the least lead of each language.

    Up to ``rows_per_language`` further texts of a language, a fifth of its texts when there are few,
    stay out of its dictionary and are identified. The least lead is half of the ``quantile`` of the
    leads of those identified rightly. A language without such texts takes the smallest of the others.
    """
    sample, sizes = drawn(docs, 2 * rows_per_language)
    has = Window.partitionBy("lang")
    of = F.count("*").over(has)
    out = F.greatest(of - rows_per_language, F.floor(of / 5))
    sample = cut_lineage(sample.withColumn("apart", F.col("n") > of - out))
    dictionaries = _dictionaries(sample.filter("NOT apart"), sizes, rows_per_language, dict_bytes)
    tried = sample.filter(F.col("apart") & (F.octet_length("text") >= MIN_BYTES)).select("lang", "text")
    found = _identified(tried.repartition(F.xxhash64("text")), dictionaries, level)
    leads: dict[str, list[float]] = {}
    for row in found.filter("lang = lang_pred").select("lang", "lead").collect():
        leads.setdefault(row["lang"], []).append(row["lead"])
    least = {k: float(np.quantile(x, quantile)) / 2 for k, x in leads.items()}
    return dictionaries, {k: least.get(k, min(least.values(), default=0.0)) for k in dictionaries}


def blocks(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """Pieces of about equal length, at most ``size``."""
    n = max(1, -(-len(data) // size))
    step = -(-len(data) // n) or 1
    return (data[i : i + step] for i in range(0, len(data), step))


def _coder(content: bytes, level: int) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=dictionary, write_content_size=False, write_dict_id=False
    )


def _predict(dictionaries: dict[str, bytes], level: int):
    names = list(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [_coder(dictionaries[n], level) for n in names]
        for batch in batches:
            i = batch.schema.names.index("text")
            lang, score, margin, lead = [], [], [], []
            for text in batch.column(i).cast(pa.binary()).to_pylist():
                data = letters(text)
                if not names or not data:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    margin.append(0.0)
                    lead.append(0.0)
                    continue
                sizes = np.zeros(len(names))
                for block in blocks(data):
                    sizes += [len(c.compress(block)) for c in coders]
                best = int(np.argmin(sizes))
                # Bits saved against each other language, per block of text: a soft maximum.
                bits = 8 * (sizes[best] - sizes) * min(1.0, 256 / len(data))
                lang.append(names[best])
                score.append(float(1 / np.exp2(np.maximum(bits, -1000) / 8).sum()))
                rest = np.delete(sizes, best)
                margin.append(float((rest.min() - sizes[best]) / len(data)) if len(rest) else 1.0)
                lead.append(float(1 - sizes[best] / rest.min()) if len(rest) else 1.0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(margin, pa.float64()),
                    pa.array(lead, pa.float64()),
                ],
                names=[*batch.schema.names, "lang_pred", "score", "margin", "lead"],
            )

    return run


def _identified(docs: DataFrame, dictionaries: dict[str, bytes], level: int) -> DataFrame:
    made = T.StructType(list(docs.schema.fields)).add("lang_pred", "string")
    made = made.add("score", "double").add("margin", "double").add("lead", "double")
    return docs.mapInArrow(_predict(dictionaries, level), made)


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    *,
    level: int = 6,
    min_margin: float = 0.0,
    min_bytes: int = MIN_BYTES,
    min_leads: dict[str, float] | None = None,
) -> DataFrame:
    """``docs`` with ``lang_pred, score, margin, rejected`` (columns of those names are replaced).

    ``margin`` is what the best dictionary saves against the second best, as a share of the text's
    bytes. ``rejected`` texts of at least ``min_bytes`` have none above ``min_margin``, or save less
    than the ``min_leads`` of their language as a share of the second best's bytes: repeated words
    compress to little, which makes margins narrow but not leads. A tie of a shorter text says
    nothing. A null text, one without letters, and every text when nothing was learned, gets ``und``,
    score 0, and is rejected. Equal sizes go to the language with the most training rows.
    """
    base = docs.drop("lang_pred", "score", "margin", "rejected")
    aside = {"lead": "_own_lead"} if "lead" in base.columns else {}
    out = _identified(base.withColumnsRenamed(aside), dictionaries, level)
    least = F.lit(0.0)
    for name, lead in (min_leads or {}).items():
        least = F.when(F.col("lang_pred") == name, lead).otherwise(least)
    narrow = (F.col("margin") <= min_margin) | (F.col("lead") < least)
    narrow = narrow & (F.octet_length("text") >= min_bytes)
    out = out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | F.coalesce(narrow, F.lit(False)))
    return out.drop("lead").withColumnsRenamed({v: k for k, v in aside.items()})


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 4) == 2


def with_language(docs: DataFrame, **options) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, then identify every row."""
    train = docs.filter(~held_out(F.col("doc_id")))
    dictionaries, leads = learn_with_leads(train)
    return identify(docs, dictionaries, **{"min_leads": leads} | options)
