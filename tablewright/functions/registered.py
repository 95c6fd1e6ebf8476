"""Python functions made available to SQL text.

The built-in expressions in ``functions.text`` and ``functions.scalars`` do the
same work faster; these exist for queries written against the SQL names. They
are defined inside functions so that they travel to executors by value.
"""

# No deferred annotations here: Spark reads the type hints of vectorised functions.

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The SQL names.
COUNT_HASHTAG = "count_hashtag"
HASHTAG_TABLE = "HashtagExtractor"
LABEL = "user_label"


def hashtag_counter():
    """Vectorised count of hashtags per text."""
    import pandas as pd

    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        counts = texts.str.count(r"#\w+")
        return counts.where(texts.fillna("") != "").astype("Int32")

    return count


def hashtag_table():
    """Table function: one row per hashtag of its argument; rows travel in Arrow batches."""

    @F.udtf(returnType="hashtag: string", useArrow=True)
    class Extractor:
        def eval(self, text: str):
            import re

            for match in re.finditer(r"#\w+", text or ""):
                yield (match.group(),)

    return Extractor


def label_maker():
    """Vectorised two-column label; a missing value reads ``None``."""
    import pandas as pd

    @F.pandas_udf(T.StringType())
    def label(names: pd.Series, ages: pd.Series) -> pd.Series:
        shown = [s.astype("object").where(s.notna(), "None").astype(str) for s in (names, ages)]
        return "Name: " + shown[0] + ", Age: " + shown[1]

    return label


def register_functions(spark: SparkSession) -> None:
    """Register the functions above under their SQL names."""
    spark.udf.register(COUNT_HASHTAG, hashtag_counter())
    spark.udf.register(LABEL, label_maker())
    spark.udtf.register(HASHTAG_TABLE, hashtag_table())
