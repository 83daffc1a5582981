"""License mentions by ordered signature rules, with DataFrame functions only.

A rule is a regular expression over the words of a text (A-Z in lower case, one space between) that begins
at one of its keywords. Texts without any trace of a license are passed over by one pattern; in the others
only places with a keyword are looked at, a rule meets only the places of its keyword, and its expression
runs only where a second keyword is near. What is found are word intervals; rules have priorities, and an
interval inside another one of the same or a higher priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table, with_rows, written
from .urls import LOWER, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words a rule may span.
REACH = 24

#: Phrases that are labels wherever their words stand together: phrase and label.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Label, identifier as words, and names. Names are expressions over words; the text before the first
#: space is the keyword they begin with, so it holds no operators.
LICENSES = (
    ("gpl-1.0", "gpl 1 0", ("gnu gpl (?:version |v)?1(?: 0)?", "gplv1", "gnu general public licen[cs]e (?:version |v)?1(?: 0)?")),
    ("gpl-2.0", "gpl 2 0", ("gnu gpl (?:version |v)?2(?: 0)?", "gplv2", "gpl (?:version |v)?2(?: 0)?", "gnu general public licen[cs]e (?:version |v)?2(?: 0)?")),
    ("gpl-3.0", "gpl 3 0", ("gnu gpl (?:version |v)?3(?: 0)?", "gplv3", "gpl (?:version |v)?3(?: 0)?", "gnu general public licen[cs]e (?:version |v)?3(?: 0)?")),
    ("lgpl-2.0", "lgpl 2 0", ("gnu library general public licen[cs]e(?: (?:version |v)?2(?: 0)?)?", "lgplv2")),
    ("lgpl-2.1", "lgpl 2 1", ("gnu lesser general public licen[cs]e (?:version |v)?2 1", "lgplv2 1", "lgpl (?:version |v)?2 1")),
    ("lgpl-3.0", "lgpl 3 0", ("gnu lesser general public licen[cs]e (?:version |v)?3(?: 0)?", "lgplv3", "lgpl (?:version |v)?3(?: 0)?")),
    ("agpl-3.0", "agpl 3 0", ("gnu affero general public licen[cs]e(?: (?:version |v)?3(?: 0)?)?", "agplv3", "agpl (?:version |v)?3(?: 0)?")),
    ("gfdl-1.1", "gfdl 1 1", ("gnu free documentation licen[cs]e (?:version |v)?1 1",)),
    ("gfdl-1.2", "gfdl 1 2", ("gnu free documentation licen[cs]e (?:version |v)?1 2",)),
    ("gfdl-1.3", "gfdl 1 3", ("gnu free documentation licen[cs]e (?:version |v)?1 3", "gnu fdl")),
    ("apache-1.0", "apache 1 0", ("apache (?:software )?licen[cs]e (?:version |v)?1 0",)),
    ("apache-1.1", "apache 1 1", ("apache (?:software )?licen[cs]e (?:version |v)?1 1",)),
    ("apache-2.0", "apache 2 0", ("apache (?:software )?licen[cs]e (?:version |v)?2(?: 0)?", "apache org licenses license 2 0", "asl 2 0")),
    ("mit", "mit", ("mit licen[cs]ed?", "mit style licen[cs]e", "expat licen[cs]e", "permission is hereby granted free of charge to any person obtaining a copy")),
    ("mit-0", "mit 0", ("mit no attribution licen[cs]e",)),
    ("x11", "x11", ("x11 licen[cs]e", "x consortium licen[cs]e")),
    ("bsd-2-clause", "bsd 2 clause", ("bsd 2 clause(?: licen[cs]e)?", "simplified bsd licen[cs]e", "freebsd licen[cs]e", "two clause bsd licen[cs]e")),
    ("bsd-3-clause", "bsd 3 clause", ("bsd 3 clause(?: licen[cs]e)?", "new bsd licen[cs]e", "modified bsd licen[cs]e", "three clause bsd licen[cs]e")),
    ("bsd-4-clause", "bsd 4 clause", ("bsd 4 clause(?: licen[cs]e)?", "original bsd licen[cs]e")),
    ("0bsd", "0bsd", ("zero clause bsd(?: licen[cs]e)?",)),
    ("bsd", "bsd", ("bsd licen[cs]e", "bsd style licen[cs]e", "redistribution and use in source and binary forms with or without modification are permitted")),
    ("isc", "isc", ("isc licen[cs]e", "permission to use copy modify and or distribute this software for any purpose")),
    ("mpl-1.0", "mpl 1 0", ("mozilla public licen[cs]e (?:version |v)?1 0",)),
    ("mpl-1.1", "mpl 1 1", ("mozilla public licen[cs]e (?:version |v)?1 1", "mpl (?:version |v)?1 1")),
    ("mpl-2.0", "mpl 2 0", ("mozilla public licen[cs]e (?:version |v)?2(?: 0)?", "mpl (?:version |v)?2(?: 0)?")),
    ("epl-1.0", "epl 1 0", ("eclipse public licen[cs]e (?:version |v)?1(?: 0)?", "epl (?:version |v)?1 0")),
    ("epl-2.0", "epl 2 0", ("eclipse public licen[cs]e (?:version |v)?2(?: 0)?", "epl (?:version |v)?2 0")),
    ("cpl-1.0", "cpl 1 0", ("common public licen[cs]e(?: (?:version |v)?1 0)?",)),
    ("cddl-1.0", "cddl 1 0", ("common development and distribution licen[cs]e(?: (?:version |v)?1 0)?", "cddl (?:version |v)?1 0")),
    ("cddl-1.1", "cddl 1 1", ("common development and distribution licen[cs]e (?:version |v)?1 1", "cddl (?:version |v)?1 1")),
    ("cc0-1.0", "cc0 1 0", ("cc0(?: 1 0)?", "cc zero", "creative commons zero(?: (?:version |v)?1 0)?", "creativecommons org publicdomain zero 1 0")),
    ("cc-by-1.0", "cc by 1 0", ("cc by 1 0", "creative commons attribution 1 0", "creativecommons org licenses by 1 0")),
    ("cc-by-2.0", "cc by 2 0", ("cc by 2 0", "creative commons attribution 2 0", "creativecommons org licenses by 2 0")),
    ("cc-by-2.5", "cc by 2 5", ("cc by 2 5", "creative commons attribution 2 5", "creativecommons org licenses by 2 5")),
    ("cc-by-3.0", "cc by 3 0", ("cc by 3 0", "creative commons attribution 3 0", "creativecommons org licenses by 3 0")),
    ("cc-by-4.0", "cc by 4 0", ("cc by 4 0", "creative commons attribution 4 0(?: international)?", "creativecommons org licenses by 4 0")),
    ("cc-by-sa-2.0", "cc by sa 2 0", ("cc by sa 2 0", "creative commons attribution sharealike 2 0", "creativecommons org licenses by sa 2 0")),
    ("cc-by-sa-3.0", "cc by sa 3 0", ("cc by sa 3 0", "creative commons attribution share ?alike 3 0", "creativecommons org licenses by sa 3 0")),
    ("cc-by-sa-4.0", "cc by sa 4 0", ("cc by sa 4 0", "creative commons attribution share ?alike 4 0", "creativecommons org licenses by sa 4 0")),
    ("cc-by-nc-2.0", "cc by nc 2 0", ("cc by nc 2 0", "creativecommons org licenses by nc 2 0")),
    ("cc-by-nc-3.0", "cc by nc 3 0", ("cc by nc 3 0", "creative commons attribution non ?commercial 3 0", "creativecommons org licenses by nc 3 0")),
    ("cc-by-nc-4.0", "cc by nc 4 0", ("cc by nc 4 0", "creative commons attribution non ?commercial 4 0", "creativecommons org licenses by nc 4 0")),
    ("cc-by-nd-3.0", "cc by nd 3 0", ("cc by nd 3 0", "creative commons attribution no ?deriv(?:ative)?s 3 0", "creativecommons org licenses by nd 3 0")),
    ("cc-by-nd-4.0", "cc by nd 4 0", ("cc by nd 4 0", "creative commons attribution no ?deriv(?:ative)?s 4 0", "creativecommons org licenses by nd 4 0")),
    ("cc-by-nc-sa-3.0", "cc by nc sa 3 0", ("cc by nc sa 3 0", "creativecommons org licenses by nc sa 3 0")),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", ("cc by nc sa 4 0", "creativecommons org licenses by nc sa 4 0")),
    ("cc-by-nc-nd-3.0", "cc by nc nd 3 0", ("cc by nc nd 3 0", "creativecommons org licenses by nc nd 3 0")),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", ("cc by nc nd 4 0", "creativecommons org licenses by nc nd 4 0")),
    ("cc-by-nc", "cc by nc", ("cc by nc",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc-by-nd", "cc by nd", ("cc by nd",)),
    ("unlicense", "unlicense", ("unlicense org", "this is free and unencumbered software released into the public domain")),
    ("wtfpl", "wtfpl", ("wtfpl", "do what the fuck you want to public licen[cs]e")),
    ("zlib", "zlib", ("zlib licen[cs]e", "zlib libpng licen[cs]e")),
    ("libpng", "libpng", ("libpng licen[cs]e",)),
    ("bsl-1.0", "bsl 1 0", ("boost software licen[cs]e(?: (?:version |v)?1 0)?",)),
    ("artistic-1.0", "artistic 1 0", ("artistic licen[cs]e 1 0",)),
    ("artistic-2.0", "artistic 2 0", ("artistic licen[cs]e 2 0", "artistic licen[cs]e")),
    ("python-2.0", "python 2 0", ("python software foundation licen[cs]e(?: (?:version |v)?2)?", "psf licen[cs]e")),
    ("php-3.01", "php 3 01", ("php licen[cs]e(?: (?:version |v)?3 01)?",)),
    ("ruby", "ruby", ("ruby licen[cs]e",)),
    ("postgresql", "postgresql", ("postgresql licen[cs]e",)),
    ("openssl", "openssl", ("openssl licen[cs]e",)),
    ("ms-pl", "ms pl", ("microsoft public licen[cs]e",)),
    ("ms-rl", "ms rl", ("microsoft reciprocal licen[cs]e",)),
    ("eupl-1.1", "eupl 1 1", ("european union public licen[cs]e (?:version |v)?1 1", "eupl (?:version |v)?1 1")),
    ("eupl-1.2", "eupl 1 2", ("european union public licen[cs]e(?: (?:version |v)?1 2)?", "eupl (?:version |v)?1 2")),
    ("osl-3.0", "osl 3 0", ("open software licen[cs]e(?: (?:version |v)?3 0)?",)),
    ("afl-3.0", "afl 3 0", ("academic free licen[cs]e(?: (?:version |v)?3 0)?",)),
    ("ofl-1.1", "ofl 1 1", ("sil open font licen[cs]e(?: (?:version |v)?1 1)?", "open font licen[cs]e(?: (?:version |v)?1 1)?")),
    ("odbl-1.0", "odbl 1 0", ("open database licen[cs]e(?: (?:version |v)?1 0)?", "odbl(?: (?:version |v)?1 0)?")),
    ("odc-by-1.0", "odc by 1 0", ("open data commons attribution licen[cs]e",)),
    ("pddl-1.0", "pddl 1 0", ("open data commons public domain dedication",)),
    ("ogl-uk-3.0", "ogl uk 3 0", ("open government licen[cs]e(?: (?:version |v)?3 0)?",)),
    ("qpl-1.0", "qpl 1 0", ("q public licen[cs]e(?: (?:version |v)?1 0)?",)),
    ("vim", "vim", ("vim licen[cs]e",)),
    ("beerware", "beerware", ("beerware licen[cs]e", "beer ware licen[cs]e")),
    ("curl", "curl", ("curl licen[cs]e",)),
    ("ncsa", "ncsa", ("ncsa open source licen[cs]e", "university of illinois ncsa open source licen[cs]e")),
    ("upl-1.0", "upl 1 0", ("universal permissive licen[cs]e(?: (?:version |v)?1 0)?",)),
    ("sspl-1.0", "sspl 1 0", ("server side public licen[cs]e(?: (?:version |v)?1)?",)),
    ("busl-1.1", "busl 1 1", ("business source licen[cs]e(?: (?:version |v)?1 1)?",)),
    ("elastic-2.0", "elastic 2 0", ("elastic licen[cs]e(?: (?:version |v)?2 0)?",)),
    ("public-domain", "public domain", ("public domain dedication", "dedicated to the public domain", "released into the public domain")),
    ("proprietary", "proprietary", ("all rights reserved", "proprietary licen[cs]e")),
)

#: How a grant begins; each is followed by "under", maybe some filler, and a name.
GRANTS = ("licensed", "released", "distributed", "available")
_FILLER = r"under (?:the |a )?(?:terms (?:and conditions )?of (?:the |a )?)?"
#: One of these is in every text that a rule fits.
TRACE = (
    r"(?i)licen[cs]|gpl|mpl|epl|asl[^a-z0-9]+2|cddl|eupl|odbl|wtfpl|cc0|cc[^a-z0-9]+(?:by|zero)|creative ?commons|creative[^a-z0-9]+commons|"
    r"gnu[^a-z0-9]+fdl|public[^a-z0-9]*domain|all[^a-z0-9]+rights[^a-z0-9]+reserved|permission[^a-z0-9]+(?:is|to)|redistribution[^a-z0-9]+and|"
    r"clause|spdx"
)


def rules() -> list[tuple[int, int, str, str, str, str, bool]]:
    """All rules in order: rank, priority, label, keyword, second keyword, expression, whether it is a base phrase."""
    out: list[tuple[int, str, str, str, str, bool]] = []
    for label, words, names in LICENSES:
        out.append((3, label, "spdx", words.split()[0], f"spdx license identifier {words}(?: (?:only|or later))?", False))
        for name in names:
            first = name.split(" ")[0].split("(")[0]
            out.extend((2, label, grant, first, f"{grant} {_FILLER}{name}", False) for grant in GRANTS)
            out.append((1, label, first, first, name, False))
    out.extend((1, label, phrase.split()[0], phrase.split()[-1], phrase, True) for phrase, label in BASE)
    out.sort(key=lambda rule: -rule[0])
    return [(rank, *rule) for rank, rule in enumerate(out)]


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rules(), "rank int, priority int, label string, keyword string, needs string, pattern string, base boolean")


def detections(rows: DataFrame, row_col: str, text_col: str) -> DataFrame:
    """``row, start, stop, rank, priority, label, base, kept`` of every place where a rule fits.

    ``kept`` is false if another detection with the same or a higher priority covers the interval and is
    longer or comes first in the order of rules. Base phrases are found wherever they stand.
    """
    spark = rows.sparkSession
    table_ = F.broadcast(rule_table(spark))  # as many rows as there are rules, whatever the data
    keywords = F.array(*[F.lit(k) for k in sorted({r[3] for r in rules()})])
    low = F.translate(F.col(text_col), UPPER, LOWER)
    words = rows.where(F.col(text_col).rlike(TRACE)).select(F.col(row_col).alias("row"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("words"))
    at = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(keywords, w), i)), lambda i: i.isNotNull())
    places = words.select(
        "row", F.explode(F.transform(at, lambda i: F.struct(i.alias("start"), F.get("words", i).alias("keyword"), F.concat_ws(" ", F.slice("words", i + 1, REACH)).alias("near")))).alias("p")
    ).select("row", "p.*")
    fits = F.regexp_substr("near", F.concat(F.lit("^(?:"), "pattern", F.lit(")(?= |$)")))
    found = places.join(table_, "keyword").where(F.contains("near", "needs")).withColumn("match", fits).where("match is not null")
    found = found.select("row", "start", (F.col("start") + F.size(F.split("match", " "))).alias("stop"), "rank", "priority", "label", "base")
    near = W.partitionBy("row").orderBy("start").rangeBetween(-REACH, REACH)
    others = F.collect_list(F.struct("start", "stop", "rank", "priority")).over(near)
    longer = lambda o: (o["stop"] - o["start"] > F.col("stop") - F.col("start")) | (o["rank"] < F.col("rank"))
    covers = lambda o: (o["start"] <= F.col("start")) & (o["stop"] >= F.col("stop")) & (o["priority"] >= F.col("priority")) & longer(o)
    return found.withColumn("others", others).withColumn("kept", ~F.exists("others", covers)).drop("others")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: words, base phrases, labels and the share of words that kept detections cover.

    Words are runs of letters, digits and characters beyond ASCII. A missing or empty text has no words, no
    labels and score 0; repeated rows are scanned each. ``detections`` gives the single places.
    """
    docs, key = with_rows(docs, id_col, "licenses-rows")
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[key].cast("bigint").alias("row"), docs[id_col].cast("bigint").alias("doc_id"), text.alias("text"))
    found = written(detections(rows, "row", "text"), "licenses-found")
    before = W.partitionBy("row").orderBy("start", "stop", "rank").rowsBetween(W.unboundedPreceding, -1)
    stop = F.when(F.col("kept"), F.col("stop"))
    fresh = F.when(F.col("kept"), F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max(stop).over(before), "start"))))
    base, named = F.when(F.col("base"), F.col("start")), lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_row = (
        found.withColumn("fresh", fresh)
        .groupBy("row")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(base).cast("bigint").alias("first_word"),
            F.max(base).cast("bigint").alias("last_word"),
            named(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
            named(F.when(F.col("base") | F.col("kept"), F.col("label"))).alias("labels"),
            F.sum("fresh").alias("covered"),
        )
    )
    counted = rows.select("row", "doc_id", F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("bigint").alias("n_words"))
    return counted.join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.when(F.col("covered") > 0, F.least(F.lit(1.0), F.col("covered") / F.col("n_words"))).otherwise(0.0).alias("score"),
    )


def op1_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
