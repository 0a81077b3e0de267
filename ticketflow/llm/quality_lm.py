"""Quality classifier: perplexity under a model of trusted text.

An interpolated modified Kneser-Ney bigram model is counted on all trusted texts
but a calibration part.  Its counts lie in shards, sorted by hash; every batch
of texts joins its distinct words and pairs, sorted too, with the shards that
hold them, and sums the log-probabilities of each text.  So the texts are read
where they lie, no text or pair of theirs is shuffled, and a frequent word is
one row of a batch's join.

The threshold of each language is a quantile of the perplexity of the trusted
texts that were not learnt from; a language with few of them, or so few that the
quantile is the worst one's perplexity, takes the quantile of all.

Defined results: a null or empty text is the end mark alone; a null language is
''; repeated rows are scored each; without any trusted text the threshold is null
and every text is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, read, stored
from .ngram_lm import score, train

QUANTILE = 0.995
#: A language with fewer calibration texts takes the quantile of all of them.
MIN_CALIBRATION = 30
#: Up to so many trusted ids (8 bytes each) go to every task; more are joined by a shuffle.
MOST_SENT = 1_000_000


def thresholds(scored: DataFrame, lang: str, log_ppl: str, quantile: float = QUANTILE,
               least: int = MIN_CALIBRATION) -> tuple[DataFrame, float | None]:
    """((lang, edge) of languages with enough rows that some lie above it, the edge of all): the quantile of log10
    perplexity, found in a histogram of steps of 1/1000, so that no language's rows meet in a task."""
    bins = stored(scored.select(F.col(lang).alias("_l"), F.floor(F.col(log_ppl) * 1000).alias("bin"))
                  .groupBy("_l", "bin").agg(F.count(F.lit(1)).alias("n")), "calibration")

    def edges(rows: DataFrame, by: list[str]) -> DataFrame:
        upto, whole = Window.partitionBy(*by).orderBy("bin"), Window.partitionBy(*by)
        return (rows.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
                .where(F.col("upto") >= F.col("all") * F.lit(quantile))
                .groupBy(*by).agg(((F.min("bin") + 1) / 1000).alias("edge"), F.first("all").alias("all")))
    one = bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("_one", F.lit(1))
    every = edges(one, ["_one"]).first()
    enough = (F.col("all") >= least) & (F.col("all") - F.ceil(F.col("all") * F.lit(quantile)) >= 1)
    return edges(bins, ["_l"]).where(enough).select("_l", "edge"), every.edge if every else None


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
             quantile: float = QUANTILE) -> DataFrame:
    """Perplexity, threshold of its language and kept for every row; ``trusted`` holds the ids of trusted texts."""
    ids = stored(trusted.select(F.col(id_col).alias("_id")).where(F.col(id_col).isNotNull()).distinct()
                 .withColumn("_learn", ~held_out("_id", 5)), "trusted")
    named = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(lang), F.lit("")).alias("_lang"), F.col(text).alias("_t"))
    learn = ids.where("_learn").select("_id")
    few = learn.count() <= MOST_SENT
    model = train(named.join(F.broadcast(learn) if few else learn, "_id", "left_semi"), "_t")
    scored = stored(score(named, model, ["_id", "_lang"], "_t").select(
        "_id", "_lang", "n_tokens", F.col("score").alias("log10_prob"),
        (-F.col("score") / F.col("n_tokens")).alias("_log")), "scored")
    edge, every = thresholds(scored.join(ids.where(~F.col("_learn")), "_id", "left_semi"), "_lang", "_log", quantile)
    limit = F.coalesce("edge", F.lit(every).cast("double")) if model.pairs else F.lit(None).cast("double")
    out = scored.join(edge.withColumnRenamed("_l", "_lang"), "_lang", "left")
    return out.select(F.col("_id").alias(id_col), F.col("_lang").alias(lang), "n_tokens", "log10_prob",
                      F.pow(F.lit(10.0), "_log").alias("perplexity"), F.pow(F.lit(10.0), limit).alias("threshold"),
                      F.coalesce(F.col("_log") <= limit, F.lit(True)).alias("kept"))


def op1_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read(spark, sf_dir, "labels").where("quality = 1 and coalesce(toxic, 0) = 0")
    return classify(read(spark, sf_dir, "documents"), trusted)


QUERIES = {"op1_quality_lm": op1_quality_lm}
