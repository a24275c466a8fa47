"""Shuffle and split sizes for the amount of input.

A shuffle of S bytes from M map to R reduce tasks moves M * R blocks. With splits of a given size, M is
the input by the split, so the mean block is ``growth * split / R``: the split is chosen together with R.
"""

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: What a reduce task should read, and what it reads at most.
REDUCE_BYTES = 256 << 20
MAX_REDUCE_BYTES = 4 << 30
#: The least mean size of a shuffle block.
BLOCK_BYTES = 64 << 10
_PARTITIONS = "spark.sql.shuffle.partitions"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def sizes(n_bytes: int, growth: float = 1.0) -> tuple[int, int]:
    """Reduce tasks and bytes of a split for an input of ``n_bytes``.

    ``growth`` is how much larger rows are in a shuffle than in the input: about 1 for CSV text, several
    times for encoded Parquet columns and compressed text. Reduce tasks read REDUCE_BYTES while the
    blocks stay large enough; beyond, splits and reduce tasks grow alike, up to MAX_REDUCE_BYTES.
    """
    shuffled = n_bytes * growth
    balanced = math.sqrt(shuffled * growth / BLOCK_BYTES)
    partitions = max(min(shuffled / REDUCE_BYTES, balanced), shuffled / MAX_REDUCE_BYTES, 1)
    return math.ceil(partitions), math.ceil(BLOCK_BYTES * math.ceil(partitions) / growth)


def _bytes(setting: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    text = setting.strip().lower().removesuffix("b")
    return int(text[:-1]) << units[text[-1]] if text[-1:] in units else int(text)


@contextmanager
def sized_for(spark: SparkSession, n_bytes: int, growth: float = 1.0) -> Iterator[None]:
    """Raise the session's partition settings for what runs inside, where they are too small for the input;
    afterwards they are as before. Settings are never lowered: adaptive execution joins small shuffle
    partitions by itself, but nothing splits one that is merely large."""
    before = {key: spark.conf.get(key) for key in (_PARTITIONS, _SPLIT)}
    partitions, split = sizes(n_bytes, growth)
    partitions = max(partitions, int(before[_PARTITIONS]))
    split = max(split, _bytes(before[_SPLIT]))
    try:
        spark.conf.set(_PARTITIONS, partitions)
        spark.conf.set(_SPLIT, f"{split}b")
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
