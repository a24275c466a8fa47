"""License scan of a file tree, with DataFrame functions only.

Lines and comment blocks that speak of a license, and license files as a whole and by paragraph, are
matched to templates by the cosine of sparse TF-IDF vectors; SPDX lines by their identifiers. Files without a match inherit from the nearest directory above them that has a
license file, by joins of paths. Equal passages are weighed once and their matches joined back.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import written
from tillbook.llm.license_texts import STANDARD

#: The notices that files use to name a license, by SPDX identifier.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause New or Revised License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Lines that are looked at, and names of license files.
CUE = "licen[sc]e|licensing|spdx|public domain|copyright"
LICENSE_FILE = "^(LICEN[SC]E|COPYING|NOTICE|UNLICENSE)([.-].*)?$"
THRESHOLD = 0.6
_SPLIT = "[^a-z0-9.]+"
#: Neighbouring comment lines, and comments and strings that have an end mark. Quantifiers are possessive:
#: others recurse by line.
_RUNS = r"(?m)(?:^[ \t]*+(?://|#|;|--|%|\*|/\*|<!--|\.\.|!|'|(?:dnl|REM|rem)\b)[^\n]*+(?:\n|\z)){2,}+"
_SPANS = r"""(?s)/\*.*?(?:\*/|\z)|<!--.*?(?:-->|\z)|\"{3}.*?(?:\"{3}|\z)|'{3}.*?(?:'{3}|\z)"""
#: Lines without a letter or digit part paragraphs.
_PARTING = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
#: Paragraphs of license files that are looked at.
_TITLE_CUE = f"{CUE}|creative commons|cc0|attribution"
#: An SPDX line's expression, and the names in it without what says whether later versions are meant.
_SPDX = r"(?i)spdx-license-identifier:[ \t]*+(\(*[a-z0-9.+-]+\)*(?:[ \t]+(?:and|or|with)[ \t]+\(*[a-z0-9.+-]+\)*)*)"
_SPDX_NAME = r"([a-z0-9][a-z0-9.-]*?)(?:-only|-or-later|\+)?(?=[-.]*(?:[\s()]|$))"


def _tokens(text: Column) -> Column:
    """Words of a-z, 0-9 and dots; dots at a word's ends don't count."""
    words = F.transform(F.split(F.lower(text), _SPLIT), lambda w: F.trim(w, F.lit(".")))
    return F.filter(words, lambda w: w != "")


def templates(spark: SparkSession) -> DataFrame:
    """The notices, and the standard texts, which leave the document frequencies as they are."""
    rows = [(*t, True) for t in TEMPLATES] + [(*t, False) for t in STANDARD]
    return spark.createDataFrame(rows, "license string, text string, counted boolean")


def _counted(rows: DataFrame) -> Column:
    return F.col("counted") if "counted" in rows.columns else F.lit(True)


def _by_identifier(distinct: DataFrame, known: DataFrame) -> DataFrame:
    """(no, license, score) of the passages that name licenses of ``known`` in SPDX lines."""
    expressions = F.regexp_extract_all("passage", F.lit(_SPDX), F.lit(1))
    names = distinct.where(F.lower("passage").contains("spdx-license-identifier")).select("no", F.explode(expressions).alias("expression"))
    names = names.select("no", F.explode(F.regexp_extract_all(F.lower("expression"), F.lit(_SPDX_NAME), F.lit(1))).alias("name")).distinct()
    return names.join(known.select("license", F.lower("license").alias("name")).distinct(), "name").select("no", "license", F.lit(1.0).alias("score"))


def match(passages: DataFrame, known: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(passage, license, score) of the distinct passages whose best cosine reaches ``threshold``.

    ``passages`` has a row per occurrence. A word's document frequency counts all occurrences and all
    templates, but those whose ``counted``, if there is such a column, is false. A name in an SPDX line
    scores 1. Scores are rounded to 6 decimals; of equal scores the first license by name wins.
    """
    distinct = written(
        passages.where("passage is not null").groupBy("passage").agg(F.count_if(_counted(passages)).alias("n"))
        .withColumn("no", F.monotonically_increasing_id()), "passages"
    )
    texts = distinct.select("passage", "n", F.lit(False).alias("known")).unionByName(
        known.select(F.col("text").alias("passage"), _counted(known).cast("long").alias("n"), F.lit(True).alias("known"))
    )
    total = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequency = (
        texts.select("n", "known", F.explode(F.array_distinct(_tokens(F.col("passage")))).alias("token"))
        .groupBy("token").agg(F.sum("n").alias("df"), F.max("known").alias("known"))
        .select("token", "known", (F.log((F.lit(total) + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    )

    def weights(rows: DataFrame, key: str, text: str) -> DataFrame:
        counted = rows.select(key, F.explode(_tokens(F.col(text))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("tf"))
        return counted.join(frequency, "token").select(key, "token", "known", (F.col("tf") * F.col("idf")).alias("w"))

    vectors = written(weights(distinct, "no", "passage"), "passage_weights")
    sides = weights(known.select("license", "text").distinct().withColumn("template", F.concat_ws("\n", "license", "text")), "template", "text")
    # the words that no template has bound a passage's cosine to any; the margin is for rounding
    square = F.col("w") * F.col("w")
    lengths = written(
        vectors.groupBy("no").agg(F.sqrt(F.sum(square)).alias("length"), F.sqrt(F.sum(F.when(F.col("known"), square))).alias("reach"))
        .where(F.col("reach") >= (threshold - 1e-5) * F.col("length")).select("no", "length"), "passage_lengths"
    )
    side_lengths = sides.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("side_length"))
    near = vectors.where("known").join(lengths.select("no"), "no")
    dots = near.join(sides.select("template", "token", F.col("w").alias("v")), "token").groupBy("no", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(lengths, "no").join(side_lengths, "template").select(
        "no", F.substring_index("template", "\n", 1).alias("license"), F.round(F.col("dot") / (F.col("length") * F.col("side_length")), 6).alias("score")
    )
    best = scored.where(F.col("score") >= threshold).unionByName(_by_identifier(distinct, known)).groupBy("no").agg(F.min(F.struct((-F.col("score")).alias("down"), "license")).alias("best"))
    return distinct.join(best, "no").select("passage", F.col("best.license").alias("license"), (-F.col("best.down")).alias("score"))


def _parents(path: Column) -> Column:
    """The directories above a path, the deepest first; the root is the empty text."""
    steps = F.split(path, "/")
    return F.transform(F.sequence(F.size(steps) - 1, F.lit(0), F.lit(-1)), lambda k: F.concat_ws("/", F.slice(steps, 1, k)))


def scan(files: DataFrame, known: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per file: file_id, path, own_license, own_score, license, inherited_from.

    ``files``: file_id, path, text; ``known``: license, text, and counted if some weigh in no word's
    frequency. Matched are every line with a cue word, every block of comment lines and paragraph of one
    that has a cue word, and of files with a license file's name the whole text and its paragraphs with a
    cue; a file's own license is its best match. Only lines and whole texts weigh in frequencies. A
    directory's license is that of the best match among its license files, the first path among equals.
    Files without an own license take that of the nearest directory above that has one, and name it.
    Null and empty texts have no own license; files without a path inherit nothing; repeated rows stay,
    and rows of one file_id share the best match of all. Empty tables give an empty one; other columns
    play no part.
    """
    files = files.select("file_id", "path", "text")
    # a file_id may be null or repeated: rows are matched by what they hold
    named = files.select("file_id", "path", F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE).alias("is_license"), "text")
    spoken = F.filter(F.split("text", "\n"), lambda line: F.lower(line).rlike(CUE))
    none = F.array().cast("array<string>")
    lines = F.array_distinct(F.concat(spoken, F.when(F.col("is_license"), F.array("text")).otherwise(none)))
    blocks = F.concat(*(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)) for pattern in (_RUNS, _SPANS)))
    parted = F.flatten(F.transform(blocks, lambda block: F.split(block, _PARTING)))
    more = F.filter(F.concat(blocks, parted), lambda block: F.lower(block).rlike(CUE) & block.contains("\n"))
    paragraphs = F.filter(F.split("text", _PARTING), lambda p: F.lower(p).rlike(_TITLE_CUE))
    more = F.array_except(F.concat(more, F.when(F.col("is_license"), paragraphs).otherwise(none)), lines)
    lines = named.where(F.lower("text").rlike(CUE) | F.col("is_license")).select(
        "file_id", "path", "is_license",
        F.inline(F.concat(
            F.transform(lines, lambda p: F.struct(p.alias("passage"), F.lit(True).alias("counted"))),
            F.transform(more, lambda p: F.struct(p.alias("passage"), F.lit(False).alias("counted"))),
        )),
    )
    lines = written(lines, "license_lines")
    matched = lines.join(match(lines.select("passage", "counted"), known, threshold), "passage")
    best = F.min(F.struct((-F.col("score")).alias("down"), "license")).alias("best")
    own = written(matched.groupBy("file_id", "path", "is_license").agg(best), "own_licenses")
    parent = F.expr("array_join(slice(split(path, '/'), 1, size(split(path, '/')) - 1), '/')")
    directories = own.where("is_license").groupBy(parent.alias("directory")).agg(
        F.min(F.struct("best.down", "path", "best.license")).alias("first")
    ).select("directory", F.col("first.license").alias("directory_license"))

    rows = named.select("file_id", "path")
    single = own.select(F.col("file_id").alias("own_id"), F.col("path").alias("own_path"), "best")
    here = rows.join(single, rows["file_id"].eqNullSafe(single["own_id"]) & rows["path"].eqNullSafe(single["own_path"]), "left")
    here = here.select("file_id", "path", F.col("best.license").alias("own_license"), (-F.col("best.down")).alias("own_score"))
    folder = parent.alias("folder")
    folders = rows.where("path is not null").select(folder).distinct()
    nearest = (
        folders.select("folder", F.posexplode(F.concat(F.array("folder"), _parents(F.col("folder")))).alias("up", "directory"))
        .join(directories, "directory").groupBy("folder").agg(F.min(F.struct("up", "directory", "directory_license")).alias("near"))
    )
    return here.withColumn("folder", parent).join(nearest, "folder", "left").select(
        "file_id", "path", "own_license", "own_score", F.coalesce("own_license", "near.directory_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("near.directory")).alias("inherited_from"),
    )
