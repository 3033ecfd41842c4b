"""Noun lemmas as a table job (T7) and the deep-clean chain that uses it (T4).

The reference looks every token up in WordNet. Here the dictionary is the
corpus itself: a candidate form made by a noun suffix rule counts only if it
occurs as a token somewhere in the table, and the shortest known form wins
(the original first on equal length). The work is relational:

1. explode each text's distinct tokens;
2. distinct vocabulary (partial aggregate, so a token filling a third of the
   corpus shrinks map-side before the shuffle);
3. candidates per vocabulary token, semi-joined with the vocabulary, reduced
   to one lemma per token; only tokens whose lemma differs are kept;
4. these are written and counted. Up to ``IN_ROW`` of them go to the workers and
   each text's tokens are replaced in their row: one lookup per distinct token
   of a portion of an Arrow batch, nothing of the texts is shuffled or joined back;
5. more of them are joined with each text's distinct tokens (hot tokens by
   broadcast, see ``join_hot``) into one replacement map per text (bounded by
   that text's distinct tokens), which is joined back by id and applied to the
   token array in place.

The tokens are written once, beside their id, to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinari.config import NOUN_SUFFIX_RULES, SPARK_ENGLISH_STOPWORDS, CleaningConfig
from opinari.functions import text as tx
from opinari.operators.base import join_hot, portions, with_columns_once, written

#: Tokens with another lemma that the workers may hold (about 50 bytes each).
IN_ROW = 500_000
#: Tokens that the lookup takes at once (about 100 bytes each).
PORTION = 100_000


def candidate_forms(token) -> F.Column:
    """``[token] + rule results`` (null where a rule does not apply)."""
    t = F.col(token) if isinstance(token, str) else token
    forms = [t]
    for suffix, repl in NOUN_SUFFIX_RULES:
        stem = F.substr(t, F.lit(1), F.length(t) - F.lit(len(suffix)))
        forms.append(F.when(t.endswith(suffix), F.concat(stem, F.lit(repl))))
    return F.array(*forms)


def lemma_map(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """Vocabulary → lemma mapping ``(token, lemma, n)`` from a long token table; ``n`` is
    the token's number of rows."""
    vocab = tokens.groupBy(F.col(token_col).alias("token")).agg(F.count(F.lit(1)).alias("n"))
    cands = (vocab.select("token", "n", F.posexplode(candidate_forms("token")).alias("idx", "cand"))
             .filter(F.col("cand").isNotNull() & (F.length("cand") > 0)))
    known = cands.join(vocab.select(F.col("token").alias("cand")), "cand", "left_semi")
    # The least (length, rule) decides, as a number; the form follows from the rule.
    best = known.groupBy("token", "n").agg(F.min(F.length("cand") * 100 + F.col("idx")).alias("_rank"))
    return best.select("token", F.element_at(candidate_forms("token"), (F.col("_rank") % 100 + 1).cast("int")).alias("lemma"), "n")


def replaced(changed: DataFrame):
    """``changed (token, lemma)`` as a column function of a token array. Not to
    be repeated by filters that are pushed below it, so marked as such."""
    table = changed.select("token", "lemma").toArrow().combine_chunks()
    shared = changed.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = dict(zip(*(shared.value.column(c).to_pylist() for c in ("token", "lemma"))))
        for batch in batches:
            for at, n in portions(pc.list_value_length(batch), PORTION):
                part = batch.slice(at, n)
                first = part.offsets[0].as_py()
                codes = part.values.slice(first, part.offsets[n].as_py() - first).dictionary_encode()
                # Each distinct token of a portion is looked up once.
                found = pa.array([table.get(t, t) for t in codes.dictionary.to_pylist()], pa.string())
                yield pa.ListArray.from_arrays(pc.subtract(part.offsets, first), found.take(codes.indices))

    return F.arrow_udf(run, "array<string>").asNondeterministic()


def lemmatize(df: DataFrame, id_col: str, tokens_col: str, out_col: str = "lemmas") -> DataFrame:
    """Replace each token of ``tokens_col`` with its lemma; the result is
    an array in the original order. Rows with no tokens get ``[]``. ``id_col``
    must be unique if more than ``IN_ROW`` tokens have another lemma."""
    df = written(df, "tokens")
    per_doc = df.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("token"))
    changed = written(lemma_map(per_doc).filter(F.col("lemma") != F.col("token")), "lemmas")
    n = changed.count()
    none = F.array().cast("array<string>")
    if not n:
        return df.withColumn(out_col, F.coalesce(F.col(tokens_col), none))
    if n <= IN_ROW:
        return df.withColumn(out_col, replaced(changed)(F.coalesce(F.col(tokens_col), none)))
    total = df.agg(F.coalesce(F.sum(F.size(F.array_distinct(tokens_col))), F.lit(0))).first()[0]
    repl = (join_hot(per_doc, changed, "token", "n", total, "inner")
            .groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_m")))
    toks = F.col(tokens_col)
    lem = F.when(F.col("_m").isNull(), toks).otherwise(
        F.transform(toks, lambda t: F.coalesce(F.try_element_at(F.col("_m"), t), t)))
    return df.join(repl, id_col, "left").withColumn(out_col, F.coalesce(lem, none)).drop("_m")


def drop_stopwords(df: DataFrame, tokens_col: str, stopwords=SPARK_ENGLISH_STOPWORDS) -> DataFrame:
    """T6 at table level: Spark ML's ``StopWordsRemover`` tests each token
    against a hash set (the ``Column`` form in ``functions.text`` scans the
    list per token). Tokens are already lower-cased, so the comparison is
    case-sensitive."""
    from pyspark.ml.feature import StopWordsRemover

    remover = StopWordsRemover(inputCol=tokens_col, outputCol="_sw", stopWords=list(stopwords),
                               caseSensitive=True)
    return remover.transform(df).drop(tokens_col).withColumnRenamed("_sw", tokens_col)


def deep_clean(df: DataFrame, text_col: str = "value", out_col: str = "cleaned_comment",
               id_col: str = "comment_id", config: CleaningConfig = CleaningConfig()) -> DataFrame:
    """T4: text rules (T4a–c), lower case, then tokens → stop words → lemmas
    → joined by one space. ``id_col`` as in :func:`lemmatize`."""
    d = with_columns_once(df, _deep=tx.deep_clean_text(F.col(text_col), config.remove_punctuation))
    if not (config.remove_stopwords or config.lemmatize):
        return d.withColumn(out_col, F.trim(F.col("_deep"))).drop("_deep")
    d = d.withColumn("_toks", tx.tokenize(F.col("_deep"), lowered=True)).drop("_deep")
    if config.remove_stopwords:
        d = drop_stopwords(d, "_toks")
    if config.lemmatize:
        d = lemmatize(d, id_col, "_toks", "_lem").drop("_toks").withColumnRenamed("_lem", "_toks")
    # Filters on the text must not join the tokens once more.
    return with_columns_once(d, _joined=F.array_join("_toks", " ")).select(*df.columns, F.col("_joined").alias(out_col))
