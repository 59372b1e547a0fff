"""URL filter with redirect equivalence, in DataFrame operations only.

Rules allow or block a host (and its subdomains) under a path prefix; of the
rules that fit a url the longest wins. Urls without a rule follow their
equivalence class: connected components over redirect and canonical-link edges
(``<link rel="canonical">`` and ``<meta http-equiv="refresh">`` of the pages, and
an optional table of redirects). A class with an explicitly allowed member
allows its members without a rule; else one with a blocked member blocks them;
else they are allowed. A url's own rule always stands, so an explicit allow
takes precedence over a block that reaches it.

Nodes of the graph are urls without fragment, scheme and host lower-cased;
targets without a host are resolved against their page. Only pages and targets
that have an edge take part in the joins on nodes; the rest stay in a narrow
scan. Rules are few and become one expression; a site that is the target of a
third of all pages is a node of very many edges, which the components spread.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule, has no edges and is allowed; null and empty html has no edges;
edges to the page itself are ignored; repeated rows are judged each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.llm.common import kept, scratch
from pulsegrid.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased."""
    return _lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, null if none fits.
    A rule is (verdict, host/path); equal lengths: the first given wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the longest is asked first, of equal ones the first given
    for _, (kind, text) in sorted(enumerate(rules), key=lambda r: (len(r[1][1]), -r[0])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _with_node(df: DataFrame, url: str, name: str) -> DataFrame:
    """Add the node of a url column: scheme and host lower-cased, no fragment,
    an empty path as ``/``; null if there is no scheme. (Steps are columns of
    their own, so that no expression is evaluated or compiled twice.)"""
    start = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*"
    df = df.withColumn("_u", F.regexp_replace(F.col(url), r"(?s)#.*$", ""))
    df = df.withColumns({"_head": F.regexp_extract("_u", start, 0), "_rest": F.regexp_replace("_u", start, "")})
    rest = F.concat(F.when((F.col("_rest") == "") | F.col("_rest").startswith("?"), "/").otherwise(""), "_rest")
    return df.withColumn(name, F.when(F.col("_head") != "", F.concat(_lower(F.col("_head")), rest))).drop("_u", "_head", "_rest")


def _resolved(df: DataFrame) -> DataFrame:
    """Replace ``target``, a link of ``page``, by a full url (else null)."""
    df = df.withColumns({
        "target": F.trim(F.replace("target", F.lit("&amp;"), F.lit("&"))),
        "_origin": F.regexp_extract("page", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0),
        "_scheme": F.regexp_extract("page", r"^[A-Za-z][A-Za-z0-9+.-]*:", 0),
        "_folder": F.regexp_extract("page", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/(?:[^?#]*/)?", 0)})
    t = F.col("target")
    folder = F.when(F.col("_folder") == "", F.concat("_origin", F.lit("/"))).otherwise(F.col("_folder"))
    full = (F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
            .when(t.startswith("//"), F.concat("_scheme", t))
            .when(t.startswith("/"), F.concat("_origin", t))
            .when(t.rlike(r"^($|[#?]|[A-Za-z][A-Za-z0-9+.-]*:)"), None)
            .otherwise(F.concat(folder, t)))
    return df.withColumn("target", full).drop("_origin", "_scheme", "_folder")


def _edges(df: DataFrame, a: str, b: str) -> DataFrame:
    return _with_node(_with_node(df, a, "a"), b, "b").select("a", "b")


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): canonical and refresh edges that the pages' markup declares; an
    end is null where a link gives no url."""
    tags = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"(?is)<(?:link|meta)\b[^<>]*>"), 0)
    t = pages.where(F.col(html).rlike(r"(?i)canonical|http-equiv")).select(
        F.col(url).alias("page"), F.explode(tags).alias("tag"))

    def attribute(name: str) -> Column:
        """Its value; the pattern takes quotes along, which are cut off."""
        raw = F.regexp_extract("tag", rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
        return F.regexp_replace(raw, r"""^["']|["']$""", "")

    t = t.withColumns({k.replace("-", "_"): attribute(k) for k in ("rel", "href", "http-equiv", "content")})
    to = F.regexp_extract("content", r"""(?is)url\s*=\s*['"]?\s*([^'"]+)""", 1)
    target = (F.when(F.col("tag").rlike(r"(?is)^<link\b") & F.col("rel").rlike(r"(?i)(^|\s)canonical(\s|$)"), F.col("href"))
              .when(F.col("tag").rlike(r"(?is)^<meta\b") & F.col("http_equiv").rlike("(?i)^refresh$"), to))
    return _edges(_resolved(t.select("page", target.alias("target"))), "page", "target")


def judge(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None, url: str = "url",
          html: str = "html", page_id: str = "page_id") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``redirects`` has
    the columns source and target (urls)."""
    edges = link_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(_edges(redirects.select("source", "target"), "source", "target"))
    with scratch(pages.sparkSession, "urls") as tmp:
        nodes = tmp.save(components(tmp.save(edges)))
        _, verdict = matched_rule(rules, host_of("node"), path_of("node"))
        said = (nodes.withColumn("v", verdict).groupBy("root")
                .agg(F.max(F.col("v") == "allow").alias("allow"), F.max(F.col("v") == "block").alias("block"))
                .where("allow or block").select(F.col("root").alias("r"), F.when(F.col("allow"), "allow").otherwise("block").alias("by")))
        by_node = tmp.save(nodes.join(said, F.col("root") == F.col("r")).select("node", "by"))
        base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
        base = _with_node(base.withColumns({"host": host_of("_url"), "path": path_of("_url")}), "_url", "_n")
        rule, own = matched_rule(rules, F.col("host"), F.col("path"))
        base = base.select("page_id", "host", "path", rule.alias("rule"), own.alias("own"), "_n")
        # urls with a rule of their own ask no class: their keys are no node's, and all over the place
        ask = F.when(F.col("own").isNull(), F.col("_n")).otherwise(F.hex(F.xxhash64("page_id", "host", "path")))
        return kept(base.withColumn("_n", ask).join(by_node, F.col("_n") == F.col("node"), "left").select(
            "page_id", "host", "path", "rule", F.coalesce("own", "by", F.lit("allow")).alias("verdict")))
