"""Filter interaction audit: what every order of document filters keeps, removes and duplicates.

Each document becomes one failure flag per filter. Rows of one part with equal flags and labels are counted, and SQL's
CUBE over the flags and the part adds them up: the row of a grouping set whose selected flags are all false counts
the documents that survive that subset of filters. Every step of every order is then a join of two subsets,
the filters before it and those up to it. Only counted patterns meet in the cube, so its cost doesn't grow with the input.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, UPPER, read, written

#: The filter that fails texts which a smaller doc_id has too; the others look at one text.
COPIES = "E"
WORD_GAPS = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: A few words, B repeated words, C capitals, D symbols."""
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAPS))
    n, different = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 200,
        "B": 100 * different.cast("long") < 50 * n.cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.char_length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def patterns(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, a boolean per filter (A to E), good, toxic, n: how many rows of docs have this pattern.

    A null text is empty, a null part the empty string. A row fails E if a row with a smaller id has the same text (by
    SHA-256) anywhere in docs; rows that repeat an id don't fail by each other, and rows without an id neither fail nor make
    others fail. A document is good (toxic) if any row of labels with its id says so; labels of other documents don't count. Whole
    texts are read, of any length; other columns aren't. Rows are counted before they move, so copies and repeated rows travel as one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    alone = failures(F.col("text"))
    one = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = one.select("id", "part", F.unhex(F.sha2("text", 256)).alias("key"), *[c.alias(k) for k, c in alone.items()]).groupBy("id", "part", "key", *alone).agg(F.count(F.lit(1)).alias("n"))
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    marked = rows.where("id IS NOT NULL").join(said, "id", "left").select("id", "part", "key", *alone, "n", known("good"), known("toxic"))
    marked = marked.unionByName(rows.where("id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)}))
    # Rows of one text, part and labels, with their least id and how many rows have it.
    texts = marked.groupBy("key", "part", *alone, "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least.id").over(Window.partitionBy("key"))
    fresh = F.col("nameless") + F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    split = texts.withColumn("fresh", fresh).select("part", *alone, "good", "toxic", F.explode(F.array(F.struct(F.lit(False).alias(COPIES), F.col("fresh").alias("n")), F.struct(F.lit(True).alias(COPIES), (F.col("n") - F.col("fresh")).alias("n")))).alias("e"))
    return split.where("e.n > 0").groupBy("part", *alone, f"e.{COPIES}", "good", "toxic").agg(F.sum("e.n").alias("n")).select("part", *alone, COPIES, "good", "toxic", "n")


def survivors(counted: DataFrame, filters: list[str]) -> DataFrame:
    """part, subset, n, good, toxic: the documents that pass all filters of the subset, for each part and each subset, zeros included.

    subset has bit k set if the filter at place k of the list is in it.
    """
    cube = counted.cube("part", *filters).agg(
        F.grouping("part").alias("all_parts"), *[F.grouping(f).alias(f"any_{f}") for f in filters],
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    passed = cube.where("all_parts = 0")
    for f in filters:
        passed = passed.where((F.col(f"any_{f}") == 1) | ~F.col(f))
    subset = sum(((1 - F.col(f"any_{f}").cast("int")) * (1 << k) for k, f in enumerate(filters)), F.lit(0))
    every = counted.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(filters)) - 1))).alias("subset"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return every.join(passed.select("part", subset.alias("subset"), "n", "good", "toxic"), ["part", "subset"], "left").select("part", "subset", zero("n"), zero("good"), zero("toxic"))


def audit(counted: DataFrame, filters: list[str]) -> DataFrame:
    """One row per part, order of the filters and step: see query(). counted as patterns() gives it; no rows give no rows.

    The steps of all orders are a table of its own (600 rows for five filters), which is all that is broadcast.
    """
    spark = counted.sparkSession
    whole = (1 << len(filters)) - 1
    steps = []
    for order in permutations(range(len(filters))):
        before = 0
        for k, f in enumerate(order):
            steps.append(("".join(filters[x] for x in order), k + 1, filters[f], before, before | 1 << f, 1 << f, whole ^ 1 << f))
            before |= 1 << f
    plan = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, filter string, before int, after int, own int, others int"))
    counts = written(survivors(counted, filters), "audit-survivors")
    # Per part and filter: how many fail it, and how many fail nothing else.
    single = spark.createDataFrame([(f, 1 << k, whole ^ 1 << k) for k, f in enumerate(filters)], "filter string, own int, others int")
    at = lambda name, subset: counts.select("part", F.col("subset").alias(subset), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "good", "toxic")])
    fails = (
        at("own", "own").join(F.broadcast(single), "own").join(at("others", "others"), ["part", "others"])
        .join(at("none", "subset").where("subset = 0").drop("subset"), "part").join(at("all", "subset").where(f"subset = {whole}").drop("subset"), "part")
        .select("part", "filter", (F.col("none_n") - F.col("own_n")).alias("fails"), (F.col("others_n") - F.col("all_n")).alias("unique_fails"))
    )
    lost = lambda c: F.col(f"b_{c}") - F.col(f"a_{c}")
    return (
        at("b", "before").join(plan, "before").join(at("a", "after"), ["part", "after"]).join(fails, ["part", "filter"])
        .select(
            "part", "filter_order", "step", F.col("a_n").alias("kept"), lost("n").alias("removed"), (F.col("fails") - lost("n")).alias("redundant"), "unique_fails",
            lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.sum(lost("n")).over(Window.partitionBy("part", "filter")).alias("shapley"),
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over documents, a row per part, order and step; see patterns() for nulls, copies and repeated rows."""
    return audit(patterns(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")), [*failures(F.lit("")), COPIES])


#: The plain way: the first filter of an order that a document fails removes it.
SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
failing AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(translate(t, '{UPPER}', ''))) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts),
said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
counted AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM failing LEFT JOIN said USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
met AS (
  SELECT part, filter_order, fails, n, good, toxic, coalesce(list_min(list_transform(list_filter(string_split(fails, ''), lambda x: x <> ''), lambda x: strpos(filter_order, x))), 6) AS place
  FROM counted, orders),
steps AS (
  SELECT part, filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS f, sum(CASE WHEN place > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN place = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN place < step AND contains(fails, substr(filter_order, step::INT, 1)) THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = substr(filter_order, step::INT, 1) THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN place = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN place = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM met, range(1, 6) AS s(step) GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM steps
"""
