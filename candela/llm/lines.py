"""Line dedup by site-relative frequency, in DataFrame operations only.

A line's key is the line without spaces, tabs and carriage returns around it;
blank lines have none and always stay. For each site (host) the number of
distinct page texts that contain a line (once for each) is divided by the site's
number of distinct page texts; lines above ``max_ratio`` that at least
``least_texts`` distinct texts have are boilerplate there and are dropped from
all its pages. Sites of any size are judged by this one rule.

Texts and not pages are counted, or a group of copies that holds over
``max_ratio`` of a site would vote for its own lines and lose all its text. Copies
that differ in any byte are distinct texts. Page texts are told apart by two
64-bit hashes; of a page's copies, one list of line hashes leaves each map task.

Lines are counted by two independent 64-bit hashes, so texts are not shuffled,
and counts combine in the map tasks, so neither a hot site nor a hot line meets
in one task. A site has at most (lines a page) / ``max_ratio`` boilerplate lines.
If all sites together have at most ``broadcast_rows`` and none more than
``site_rows`` (a page's lines are compared with its site's one by one), they are
broadcast and applied in the scan; beyond that, hits are joined on (site, line)
and pages on their key.

A null text stays null and is one text of its site; a text that loses all lines
becomes empty. Rows with a null host form a site of their own. Repeated rows are
one text, and all of them lose its boilerplate. Very long texts are judged line by
line like others. An empty table gives an empty result. n_lines and n_dropped
replace input columns of these names; n_chars, where there is one, is counted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.session import materialize

_KEYS = ("transform(filter(split(`{text}`, '\\n'), l -> trim(BOTH ' \\t\\r' FROM l) != ''), "
         "l -> named_struct('a', xxhash64(trim(BOTH ' \\t\\r' FROM l)), 'b', xxhash64(7, trim(BOTH ' \\t\\r' FROM l))))")
_KEPT = ("filter(split(`{text}`, '\\n'), l -> trim(BOTH ' \\t\\r' FROM l) = '' OR NOT array_contains(__drop, "
         "named_struct('a', xxhash64(trim(BOTH ' \\t\\r' FROM l)), 'b', xxhash64(7, trim(BOTH ' \\t\\r' FROM l)))))")
_NO_SITE = "\u0000"


def _page_lines(docs: DataFrame, host: str, text: str, *more) -> DataFrame:
    """A row for each page and different line: __site, line (two hashes), and ``more``."""
    keys = F.array_distinct(F.expr(_KEYS.format(text=text)))
    site = F.coalesce(F.col(host).cast("string"), F.lit(_NO_SITE))
    return docs.select(site.alias("__site"), *more, F.explode(keys).alias("line"))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = 0.1,
                least_texts: int = 5) -> DataFrame:
    """(__site, line, pages, site_pages) of the lines above ``max_ratio``, counted over distinct texts."""
    site = F.coalesce(F.col(host).cast("string"), F.lit(_NO_SITE))
    texts = materialize(docs.select(site.alias("__site"), F.xxhash64(text).alias("__a"), F.xxhash64(F.lit(7), text).alias("__b"),
                                    F.array_distinct(F.expr(_KEYS.format(text=text))).alias("lines"))
                        .groupBy("__site", "__a", "__b").agg(F.first("lines").alias("lines")).select("__site", "lines"))
    sites = texts.groupBy("__site").agg(F.count("*").alias("site_pages"))
    counts = (texts.select("__site", F.explode("lines").alias("line")).groupBy("__site", "line")
              .agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_texts))
    return counts.join(sites, "__site").filter(F.col("pages") > max_ratio * F.col("site_pages"))


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id",
                max_ratio: float = 0.1, least_texts: int = 5, broadcast_rows: int = 50_000,
                site_rows: int = 1_000) -> DataFrame:
    """``docs`` without their sites' boilerplate lines, with n_lines and n_dropped."""
    lines = materialize(boilerplate(docs, host, text, max_ratio, least_texts).select("__site", "line"))
    total, most = lines.groupBy("__site").count().agg(F.coalesce(F.sum("count"), F.lit(0)),
                                                      F.coalesce(F.max("count"), F.lit(0))).first()
    site = F.coalesce(F.col(host).cast("string"), F.lit(_NO_SITE))
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    pages = docs.select(*columns, site.alias("__site"))
    if total <= broadcast_rows and most <= site_rows:
        drop = lines.groupBy("__site").agg(F.collect_list("line").alias("__drop"))
        judged = pages.join(F.broadcast(drop), "__site", "left")
    else:
        page = F.struct(F.col(key)).alias("__page")
        hits = (_page_lines(docs, host, text, page).join(lines, ["__site", "line"])
                .groupBy("__site", "__page").agg(F.collect_set("line").alias("__drop")))
        left = pages.withColumn("__page", page)
        judged = left.join(hits, left["__site"].eqNullSafe(hits["__site"]) & left["__page"].eqNullSafe(hits["__page"]),
                           "left").drop(hits["__site"], hits["__page"])
    split = F.split(F.col(text), "\n")
    kept = F.when(F.col("__drop").isNotNull(), F.expr(_KEPT.format(text=text))).otherwise(split)
    judged = judged.withColumn("__kept", kept)
    out = {text: F.when(F.col("__drop").isNull(), F.col(text)).otherwise(F.array_join("__kept", "\n"))}
    if "n_chars" in columns:
        out["n_chars"] = F.when(F.col("__drop").isNull(), F.col("n_chars")).otherwise(
            F.length(F.array_join("__kept", "\n"))).cast(docs.schema["n_chars"].dataType)
    n_lines = F.coalesce(F.size(split), F.lit(0)).cast("long")
    return judged.select(*[out[c].alias(c) if c in out else F.col(c) for c in columns],
                         F.when(F.col(text).isNull(), F.lit(0)).otherwise(n_lines).cast("long").alias("n_lines"),
                         F.when(F.col(text).isNull(), F.lit(0)).otherwise(
                             F.size(split) - F.size("__kept")).cast("long").alias("n_dropped"))
