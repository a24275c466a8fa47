"""Small tables with what every operator must bear, and seeded random ones."""

import random
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and house tree river running stone quickly blue seven maybe under never light people".split()


def prose(choose: random.Random, words: int) -> str:
    return " ".join(choose.choice(WORDS) + choose.choice(("", "", "", ",", ".")) for _ in range(words))


def documents(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None) -> DataFrame:
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids, texts)], DOCUMENTS)


def with_clashes(df: DataFrame) -> DataFrame:
    """Extra columns named like those that operators use or return."""
    from pyspark.sql import functions as F

    names = ["score", "length", "_part", "_row", "_open", "_fp", "n", "key", "col", "rank", "label", "path", "block", "vector", "id", "fits", "good"]
    return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])


def with_every_clash(df: DataFrame) -> DataFrame:
    """Extra columns named like every word in quotes in the subpackage, which are all names it gives to columns."""
    from pyspark.sql import functions as F

    import tillbook.llm

    sources = "".join(p.read_text() for p in sorted(Path(tillbook.llm.__path__[0]).glob("*.py")))
    names = set(re.findall(r'"([a-z_][a-z0-9_]*)"', sources)) | {f"{a}_{b}" for a in ("kept", "other", "_hot") for b in ("id", "fp")}
    taken = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit("x").alias(n) for n in sorted(names) if n not in taken])
