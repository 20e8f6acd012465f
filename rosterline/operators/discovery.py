"""Finding candidate files: keywords in text units and paths, copies by content, a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterline.operators.relational import islands, range_text


def searchable(column: str | F.Column) -> F.Column:
    """Search key of ASCII text, between spaces, so that whole words can be looked for."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", " ")), F.lit(" "))


def keyword(name: F.Column) -> F.Column:
    """School name without the word for primary school at its end."""
    return F.regexp_replace(name, " ilkokulu$", "")


def keyword_hits(units: DataFrame, keywords: DataFrame, text: str = "text", word: str = "keyword") -> DataFrame:
    """Units that hold a keyword as whole words.

    The distinct runs of words of a unit, as long as any keyword, are looked up among the ``keywords``, which go to every
    executor: no text is dealt anew or put beside each of its words, only hits leave a task.
    """
    words = F.split(F.trim(searchable(text)), " ")
    lengths = [n for (n,) in keywords.where(F.col(word).isNotNull()).select(F.size(F.split(word, " "))).distinct().collect()]

    def runs_of(n: int) -> F.Column:
        if n == 1:
            return F.col("__words")
        starts = F.when(F.size("__words") >= n, F.sequence(F.lit(1), F.size("__words") - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice("__words", i, n), " "))

    runs = F.array_distinct(F.concat(*map(runs_of, sorted(lengths or [1]))))
    found = units.withColumn("__words", words).withColumn("__run", F.explode(runs)).drop("__words")
    return found.join(F.broadcast(keywords), F.col("__run") == F.col(word)).drop("__run")


def candidate_locations(hits: DataFrame, keys: list[str], number: str, word: str = "row") -> DataFrame:
    return range_text(islands(hits, keys, number), keys, word)


def path_only_hits(path_hits: DataFrame, content_hits: DataFrame, keys: list[str]) -> DataFrame:
    """Path hits of files where the content has no hit of the same keyword."""
    return path_hits.join(content_hits.select(*keys).distinct(), keys, "left_anti")


def content_duplicates(files: DataFrame, content: str, order: str, ok: str | None = None) -> DataFrame:
    """Files with the fingerprint of their content and the first file, of those read without error, that has the same."""
    good = F.col(ok) if ok else F.lit(True)
    rows = files.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))
    first = rows.where(good).groupBy("sha256").agg(F.min(order).alias("first_order"))
    got = rows.join(first, "sha256", "left")
    return got.withColumn("duplicate_of", F.when(F.col(order) != F.col("first_order"), F.col("first_order"))).drop("first_order")


def manifest(files: DataFrame, sha: str = "sha256", status: str = "status") -> DataFrame:
    """Instances and distinct contents per status, and over all (null)."""
    return files.rollup(status).agg(F.count("*").alias("instances"), F.count_distinct(sha).alias("unique_hashes"))


def wanted_files(files: DataFrame, extensions: list[str], path: str = "path") -> DataFrame:
    """Files of the given kinds outside tool folders; lock and resource files go, and of paths that differ by case one stays."""
    name = F.element_at(F.split(path, "/"), -1)
    kept = files.where(F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).isin(*extensions))
    kept = kept.where(~name.startswith("~$") & ~name.startswith("._") & ~F.col(path).rlike(r"/(\.git|__pycache__|node_modules|\.venv)/"))
    first = Window.partitionBy(F.lower(path)).orderBy(path)
    return kept.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r")
