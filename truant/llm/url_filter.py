"""URL verdicts: rules first, then a tree of path templates per host. DataFrame operations only.

The tree grows level by level.  Below a node, a path segment stays literal if
it has at least MIN_ROWS rows, however many the node has; all others become the
wildcard ``*`` (with a usual file ending kept).  Every path is followed for
DEPTH segments, and on as long as its node has MIN_ROWS rows; the rest of it is
``**``.

Sibling templates with enough labels begin as one branch.  Each is held against
the pooled labels of the others in its branch, and those that differ
significantly leave it, the purer and the worse ones as branches of their own;
this is done ROUNDS times over, and whoever still differs then stays alone.  The
share of bad labels of a branch is smoothed towards that of the same templates
on all hosts, and that towards the share in all labels; templates above the
threshold are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truant.llm._common import HOT_SHARE, ascii_lower, written

MIN_ROWS = 20
DEPTH = 6
MIN_LABELS = 5
ROUNDS = 4
#: 95 % point of chi-square with one degree of freedom.
DIFFERS = 3.84
WEIGHT = 5.0
THRESHOLD = 0.5
ENDINGS = "html|htm|php|asp|aspx|jsp|pdf|xml|json|txt"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return ascii_lower(raw), F.regexp_extract(F.substr(rest, F.length(raw) + F.lit(1)), "^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host/path) that fits; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, text in sorted(rules, key=lambda r: len(r[1])):  # a longer one overrides
        h, _, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _keyed_left_join(rows: DataFrame, groups: DataFrame, on: list[str], count: str) -> DataFrame:
    """Left join to one row per key; keys with over HOT_SHARE of the rows by broadcast (at most 1 / HOT_SHARE of them)."""
    limit = max(1.0, rows.count() * HOT_SHARE)
    hot, few = F.broadcast(groups.filter(F.col(count) > limit)), groups.filter(F.col(count) <= limit)
    return rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(few, on, "left"))


def _grow(rows: DataFrame, depth: int) -> DataFrame:
    """The column ``template`` one segment longer, where the path goes on."""
    rows = rows.withColumn("segment", F.when(F.size("segments") > depth, F.get("segments", F.lit(depth))))
    counts = written(rows.filter("segment is not null").groupBy("host", "template", "segment").agg(F.count("*").alias("n")), "url-children")
    kept = written(counts.filter(F.col("n") >= MIN_ROWS).select("host", "template", "segment", "n").withColumn("literal", F.lit(True)), "url-literals")
    ending = F.regexp_extract("segment", f"\\.({ENDINGS})$", 0)
    child = F.when(F.col("literal"), F.col("segment")).otherwise(F.concat(F.lit("*"), ending))
    longer = F.when(F.col("segment").isNotNull(), F.concat("template", F.lit("/"), child)).otherwise(F.col("template"))
    parent = F.when(F.col("segment").isNotNull(), F.col("template")).otherwise(F.col("parent"))
    joined = _keyed_left_join(rows, kept, ["host", "template", "segment"], "n")
    return written(joined.withColumns({"template": longer, "parent": parent}).drop("n", "literal", "segment"), "url-level")


def templates(urls: DataFrame) -> DataFrame:
    """``urls`` (row_id, host, path, bad: 1, 0 or null for an unlabelled row) with template and parent."""
    segments = F.array_remove(F.split("path", "/"), "")
    rows = written(urls.withColumns({"segments": segments, "template": F.lit(""), "parent": F.lit("")}), "url-rows")
    depth = 0
    while (rows.agg(F.max(F.size("segments"))).first()[0] or 0) > depth:  # ends, as a node below DEPTH goes on with MIN_ROWS rows only
        if depth >= DEPTH:
            rows = _close(rows, depth)
        rows = _grow(rows, depth)
        depth += 1
    return rows.drop("segments")


def _close(rows: DataFrame, depth: int) -> DataFrame:
    """Paths that go on below a node with less than MIN_ROWS such rows end there, with ``**`` as their last segment."""
    goes_on = F.size("segments") > depth
    nodes = written(rows.filter(goes_on).groupBy("host", "template").agg(F.count("*").alias("n")), "url-nodes")
    joined = _keyed_left_join(rows, nodes, ["host", "template"], "n")
    few = goes_on & (F.col("n") < MIN_ROWS)
    return written(joined.withColumns({
        "parent": F.when(few, F.col("template")).otherwise(F.col("parent")),
        "template": F.when(few, F.concat("template", F.lit("/**"))).otherwise(F.col("template")),
        "segments": F.when(few, F.slice("segments", 1, depth)).otherwise(F.col("segments"))}).drop("n"), "url-open")


def purities(rows: DataFrame) -> DataFrame:
    """(host, template, n, branch, purity) of all templates, ``purity`` the smoothed share of bad labels of the merged branch."""
    own = written(rows.groupBy("host", "parent", "template").agg(
        F.count("*").alias("n"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bads")), "url-templates")
    everywhere = own.agg(F.coalesce(F.sum("labels"), F.lit(0)), F.coalesce(F.sum("bads"), F.lit(0))).first()
    prior = (everywhere[1] + 1) / (everywhere[0] + 2)
    shape = own.groupBy("template").agg(F.sum("labels").alias("shape_labels"), F.sum("bads").alias("shape_bads"), F.count("*").alias("hosts"))
    shape = written(shape.withColumn("shape_purity", (F.col("shape_bads") + WEIGHT * prior) / (F.col("shape_labels") + WEIGHT)), "url-shapes")
    own = _keyed_left_join(own, shape.select("template", "shape_purity", "hosts"), ["template"], "hosts")

    own = branches(own)
    of = ["host", "parent", "branch"]
    pooled = written(own.groupBy(*of).agg(F.sum("labels").alias("all_labels"), F.sum("bads").alias("all_bads"), F.count("*").alias("members"),
                                          (F.sum(F.col("shape_purity") * F.col("n")) / F.sum("n")).alias("prior")), "url-branches")
    purity = (F.col("all_bads") + WEIGHT * F.col("prior")) / (F.col("all_labels") + WEIGHT)
    return _keyed_left_join(own, pooled, of, "members").select("host", "parent", "template", "n", "branch", purity.alias("purity"))


def branches(own: DataFrame) -> DataFrame:
    """``own`` (host, parent, template, labels, bads, ...) with ``branch``: siblings that share it are merged.

    A branch is one row to its members' join, however many they are; no window
    goes over the children of a node."""
    alone = F.concat(F.lit("/"), F.col("template"))
    own = written(own.withColumn("branch", F.when(F.col("labels") >= MIN_LABELS, F.lit("")).otherwise(alone)), "url-round")
    of = ["host", "parent", "branch"]
    for r in range(ROUNDS + 1):
        pooled = written(own.groupBy(*of).agg(F.sum("labels").alias("all_labels"), F.sum("bads").alias("all_bads"), F.count("*").alias("members")), "url-pooled")
        rest, rest_bads = F.col("all_labels") - F.col("labels"), F.col("all_bads") - F.col("bads")
        share, others, pool = (F.col("bads") + 1) / (F.col("labels") + 2), (rest_bads + 1) / (rest + 2), (F.col("all_bads") + 1) / (F.col("all_labels") + 2)
        apart = F.pow(share - others, F.lit(2)) / (pool * (1 - pool) * (1 / F.col("labels") + 1 / rest)) > DIFFERS
        side = F.when(share < others, F.lit("p")).otherwise(F.lit("w")) if r < ROUNDS else alone
        moved = F.concat("branch", F.when(apart, side).otherwise(F.lit("s")))
        joined = _keyed_left_join(own, pooled, of, "members")
        own = written(joined.withColumn("branch", F.when((F.col("members") > 1) & (rest > 0), moved).otherwise(F.col("branch")))
                      .drop("all_labels", "all_bads", "members"), "url-round")
    return own


def verdicts(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
             bad_col: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages``.

    A rule decides what it fits.  Elsewhere the template does: ``block`` from a
    purity of ``threshold``, else ``allow``.  Its labels are ``bad_col`` (1, 0 or
    null) or, without one, the verdicts of the rules.  Null urls have empty host
    and path and so a template of their own; null ids and repeated rows are rows
    like others; an empty table gives an empty result; other columns are not
    read.
    """
    host, path = host_and_path(F.col(url_col))
    bad = F.col(bad_col).cast("int") if bad_col else F.lit(None).cast("int")
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), bad.alias("bad"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    if not bad_col:
        rows = rows.withColumn("bad", F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int")))
    rows = templates(rows)
    judged = written(purities(rows), "url-purities")
    out = _keyed_left_join(rows, judged.select("host", "parent", "template", "n", "purity"), ["host", "parent", "template"], "n")
    by_template = F.when(F.col("purity") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_template).alias("verdict"), "template", "purity")
