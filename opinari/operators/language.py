"""Language identification (T9) as a relational character-trigram naive Bayes
model, and the English fallback check (T8).

Training is one aggregate: trigrams of labelled texts are counted per batch
and summed per ``(lang, gram)``, then one row per gram with a column per
language. Detection scores each text in its row: a vectorised Arrow function
looks the text's trigrams up in the broadcast profile matrix, so there is no row
per trigram, no shuffle and no join back. A profile beyond ``PROFILE_CELLS``
is not broadcast: there the trigrams are exploded and joined with it. Both take
the best language by comparing

    score(d, L) = log P(L) - T_d * log(N_L + V) + sum_g n(d, g) * log(c(L, g) + 1)

where ``T_d`` is the number of trigrams of ``d``, ``N_L`` the trigram total of
``L``, ``V`` the number of distinct grams and ``c`` the profile count; grams a
language never saw contribute only the smoothing term. Texts under 10
non-blank characters are ``unknown``, as in the reference.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.functions import text as tx
from opinari.operators import base
from opinari.operators.base import with_columns_once
from opinari.session import scratch_path


def normalised(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), tx.J_WS_RUN, " ")))


def trigrams_of(c: Column) -> Column:
    """All overlapping character trigrams of a normalised text, in one
    linear regex pass (a lookahead at every character; the character itself is
    consumed, or a match could begin inside a surrogate pair).
    Slicing with ``substr`` per position would be quadratic: a character
    offset into UTF-8 is found by scanning from the start."""
    return F.regexp_extract_all(c, F.lit(r"(?s)(?=(.{3}))."), 1)


#: Characters that one numpy pass takes; longer texts are cut, so memory does not follow a text's length.
PORTION = 1 << 18
#: Characters whose trigrams are counted together.
COUNTED = 1 << 20
#: A profile of up to this many grams x languages goes to the workers as a matrix of doubles.
PROFILE_CELLS = 4_000_000
#: Beyond that the profile is joined, marked for broadcast up to this many grams.
PROFILE_BROADCAST_GRAMS = 1_000_000
#: Languages of a model at most: each is a column of the profile.
MAX_LANGUAGES = 200


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of an Arrow column, made one portion at a time."""
    for at, n in base.portions(pc.binary_length(column), PORTION):
        yield from column.slice(at, n).to_pylist()


def portions(texts: Iterable[str | None], limit: int = PORTION) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(trigrams, index of their text) in portions of about ``limit`` characters.
    A trigram is a number: three code points of 21 bits, so no two share one.
    Pieces of a longer text overlap by two characters."""
    pieces, rows, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t or "") - 2, 0), limit):
            piece = t[at:at + limit + 2]
            pieces.append(piece)
            rows.append(i)
            size += len(piece)
            if size >= limit:
                yield _trigram_numbers(pieces, rows)
                pieces, rows, size = [], [], 0
    if pieces:
        yield _trigram_numbers(pieces, rows)


def _trigram_numbers(pieces: list[str], rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(p) for p in pieces])
    inside = row[2:] == row[:-2]
    numbers = (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[inside]
    return numbers, np.array(rows, dtype=np.int32)[row[2:][inside]]


def gram_numbers(grams: list[str]) -> np.ndarray:
    return _trigram_numbers(grams, range(len(grams)))[0] if grams else np.zeros(0, np.int64)


def gram_texts(numbers: np.ndarray) -> list[str]:
    points = np.stack([numbers >> 42, numbers >> 21 & 0x1FFFFF, numbers & 0x1FFFFF], axis=1)
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    return [text[i:i + 3] for i in range(0, len(text), 3)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, c), added up within a portion."""
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        names, of_text = codes.dictionary.to_pylist(), np.asarray(codes.indices)
        for numbers, row in portions(_texts(batch.column(1)), COUNTED):
            lang = of_text[row]
            for i in np.unique(lang):
                found, c = np.unique(numbers[lang == i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([names[i]] * len(found), pa.string()),
                                                  pa.array(gram_texts(found), pa.string()),
                                                  pa.array(c, pa.int64())], names=["lang", "gram", "c"])


def gram_counts(labelled: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """lang, gram, c of all trigrams of a table's texts."""
    rows = labelled.select(F.col(lang_col).alias("lang"), normalised(text_col).alias("text"))
    return rows.mapInArrow(_counted, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


@dataclass
class TrigramModel:
    profile: DataFrame                    # gram, l0, l1, ...   (log(c + 1), null where never seen)
    languages: list[tuple]                # (lang, log_prior, log_norm) in column order
    grams: int

    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted trigram numbers and log(c + 1) per language and gram (0 where
        never seen); at most PROFILE_CELLS cells reach the driver."""
        rows = self.profile.toArrow()
        numbers = gram_numbers(rows.column("gram").to_pylist())
        order = np.argsort(numbers)
        weights = [np.nan_to_num(rows.column(f"l{i}").to_numpy())[order] for i in range(len(self.languages))]
        return numbers[order], np.array(weights)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TrigramModel:
    """Fit the profile from a labelled table: one pass counts, the counts are
    written once to the shared folder, and the model's scalars (one row per
    language) come from them."""
    spark = df.sparkSession
    labelled = df.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), text_col)
    path = scratch_path(spark, "trigrams")
    gram_counts(labelled, "lang", text_col).write.parquet(path)
    counts = spark.read.parquet(path)
    docs = {r[0]: r[1] for r in labelled.groupBy("lang").agg(F.count(F.lit(1))).limit(MAX_LANGUAGES + 1).collect()}
    if len(docs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    totals = counts.groupBy("lang").agg(F.sum("c")).collect()
    grams = counts.agg(F.count_distinct("gram")).first()[0]
    n = sum(docs.values())
    languages = sorted((lang, math.log(docs[lang] / n), math.log(c + grams)) for lang, c in totals)
    profile = counts.groupBy("gram").agg(*[
        F.max(F.when(F.col("lang") == lang, F.log(F.col("c") + 1.0))).alias(f"l{i}")
        for i, (lang, _, _) in enumerate(languages)]) if languages else counts.select("gram").distinct()
    return TrigramModel(profile, languages, grams)


def best_language(model: TrigramModel):
    """The model as a column function of a normalised text: the most likely
    language, null for a text that shares no trigram with any language. Equal
    scores go to the later language name."""
    shared = model.profile.sparkSession.sparkContext.broadcast(
        (*model.matrix(), [x[0] for x in model.languages], np.array([x[1:] for x in model.languages])))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers, weights, names, (prior, norm) = *shared.value[:3], shared.value[3].T
        table = base.NumberTable(numbers)
        for batch in batches:
            for first, n in base.portions(pc.binary_length(batch), PORTION):
                texts = batch.slice(first, n).to_pylist()
                sums = np.zeros((len(names), n))
                for found, row in portions(texts):
                    at = table.places(found)
                    known = at >= 0
                    at, row = at[known], row[known]
                    for i, w in enumerate(weights):
                        sums[i] += np.bincount(row, w[at], n)
                count = np.array([max(len(t or "") - 2, 0) for t in texts])
                score = np.where(sums > 0, prior[:, None] - count * norm[:, None] + sums, -np.inf)
                best = len(names) - 1 - score[::-1].argmax(axis=0)
                yield pa.array(np.array(names, object)[best], pa.string(), mask=~(sums > 0).any(axis=0))

    # A filter on the language must not be pushed below and score the texts once more.
    return F.arrow_udf(run, "string").asNondeterministic()


def _in_row(model: TrigramModel) -> bool:
    return 0 < model.grams * len(model.languages) <= PROFILE_CELLS


def _short(text_col: str, min_chars: int) -> Column:
    return tx.stripped_shorter(F.coalesce(F.col(text_col), F.lit("")), min_chars)


def detect_ids(df: DataFrame, model: TrigramModel, id_col: str, text_col: str,
               out_col: str = "detected_language", min_chars: int = 10) -> DataFrame:
    """``(id_col, out_col)`` for every row of ``df`` (``id_col`` unique).

    Candidates are the languages that share at least one trigram with the
    text; a text sharing none (or under ``min_chars`` non-blank characters)
    is ``unknown``. Equal scores go to the later language name. A profile too
    large for the workers is joined with the exploded trigrams, and one sum
    per language and text is all that is shuffled after that."""
    if _in_row(model):
        return detect(df.select(id_col, text_col), model, id_col, text_col, out_col, min_chars).select(id_col, out_col)
    norm = with_columns_once(df.select(id_col, _short(text_col, min_chars).alias("_short"), text_col),
                             _grams=trigrams_of(normalised(text_col)))
    occ = norm.select(id_col, "_short", F.explode_outer("_grams").alias("gram"))
    profile = F.broadcast(model.profile) if model.grams <= PROFILE_BROADCAST_GRAMS else model.profile
    sums = occ.join(profile, "gram", "left").groupBy(id_col, "_short").agg(
        F.count("gram").alias("_t"), *[F.sum(f"l{i}").alias(f"s{i}") for i in range(len(model.languages))])
    if not model.languages:
        return sums.select(id_col, F.lit("unknown").alias(out_col))
    scores = F.array(*[F.when(F.col(f"s{i}").isNotNull(), F.struct(
        (F.lit(prior) - F.col("_t") * F.lit(norm_) + F.col(f"s{i}")).alias("score"), F.lit(lang).alias("lang")))
        for i, (lang, prior, norm_) in enumerate(model.languages)])
    best = F.array_max(F.array_compact(scores))["lang"]
    return sums.select(id_col, F.when(F.col("_short") | best.isNull(), F.lit("unknown")).otherwise(best).alias(out_col))


def detect(df: DataFrame, model: TrigramModel, id_col: str, text_col: str,
           out_col: str = "detected_language", min_chars: int = 10) -> DataFrame:
    """Add ``out_col`` with the most likely language. In its row, whatever the
    ids are; with a profile too large for that, ``detect_ids`` joined back
    (``id_col`` unique)."""
    if not _in_row(model):
        return df.join(detect_ids(df, model, id_col, text_col, out_col, min_chars), id_col, "left")
    asked = F.when(~_short(text_col, min_chars), normalised(text_col))
    return df.withColumn(out_col, F.coalesce(best_language(model)(asked), F.lit("unknown")))


def english_fallback(df: DataFrame, text_col: str, out_col: str = "detected_language") -> DataFrame:
    """T8 as a language column: ``en`` when the fallback rule holds, else
    ``unknown``."""
    return df.withColumn(out_col, F.when(tx.is_english_fallback(F.col(text_col)), F.lit("en"))
                         .otherwise(F.lit("unknown")))
