"""Text keys, similarity kernels and name evidence."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_all(spark: SparkSession) -> list[str]:
    """Everything that SQL can call: normalize_<kind>, similarity_<kind>, name_evidence and the table function file_units.

    Returns the names.
    """
    from pyspark.sql.functions import udtf

    from rosterline.functions import evidence, normalize, similarity
    from rosterline.sources.units import file_units

    for module in (normalize, similarity, evidence):
        module.register(spark)

    @udtf(returnType="kind string, sheet string, number int, text string")
    class FileUnits:
        def eval(self, path: str, content: bytes):
            yield from file_units(path, content)

    spark.udtf.register("file_units", FileUnits)
    kinds = [f"normalize_{k}" for k in normalize.NORMALISERS] + [f"similarity_{k}" for k in similarity.KERNELS]
    return [*kinds, "name_evidence", "file_units"]
