"""Block and allow decisions for urls, carried over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.common import lower_ascii, stage, without
from auditlake.llm.components import components

# (verdict, host and path) of the registered query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_ATTRIBUTE = r"""\s*=\s*["']?\s*([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    return lower_ascii(F.substring_index(F.substring_index(rest, "?", 1), "#", 1))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    at = F.locate("/", rest)
    return F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise("")


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and the start of the path."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        fits.append(
            F.when(
                ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start), F.lit(rule)
            )
        )
    return F.coalesce(*fits, F.lit(None).cast("string"))


def node_of(url: Column) -> Column:
    """Key of the resource that a url names: its text without the fragment."""
    return F.md5(F.substring_index(url, "#", 1))


def absolute(link: Column, base: Column) -> Column:
    """A link as found on a page, made absolute where it names no host."""
    scheme = F.substring_index(base, "://", 1)
    origin = F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.concat(origin, F.regexp_extract(path_of(base), r"^(.*/)?", 0))
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), link))
    )


def page_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src, dst): canonical links and redirects by ``http-equiv`` found in the pages."""
    page = pages.select(F.col(url).alias("src"), F.col(html).alias("html")).where("src is not null")
    canonical = F.regexp_extract("html", r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract("html", r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    found = page.select(
        "src",
        F.explode(
            F.array(
                # A search for the plain word first: most pages have neither.
                F.when(
                    F.col("html").rlike("(?i)canonical"),
                    F.regexp_extract(canonical, rf"(?is)\bhref{_ATTRIBUTE}", 1),
                ),
                F.when(
                    F.col("html").rlike("(?i)http-equiv"),
                    F.regexp_extract(refresh, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)""", 1),
                ),
            )
        ).alias("link"),
    ).where("link <> ''")
    return found.select("src", absolute(F.col("link"), F.col("src")).alias("dst"))


def judge_urls(
    pages: DataFrame,
    url: str,
    rules: Sequence[tuple[str, str]],
    html: str | None = None,
    links: DataFrame | None = None,
    default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A url's own rule decides. Without one, the urls that are its aliases do: those in its connected
    component over the edges of ``links`` (src, dst; redirects known from a crawl) and those read
    from ``html``. If a rule allows one of them, the url is allowed; else, if a rule blocks one,
    it is blocked; else ``default`` holds. Null urls, and urls without ``://``, have an empty host
    and path and get ``default`` or what their aliases have. Targets that were not crawled count
    as well. Repeated pages each get a row; columns of ``pages`` with the four names are replaced.
    """
    pages = without(pages, "host", "path", "rule", "verdict", "__node", "__verdict", "__alias")
    verdicts = {rule: verdict for verdict, rule in rules}

    def judged(df: DataFrame, col: str) -> DataFrame:
        df = df.withColumn("host", host_of(F.col(col))).withColumn("path", path_of(F.col(col)))
        return df.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))

    def verdict(rule: Column) -> Column:
        cases = [F.when(rule == r, F.lit(v)) for r, v in verdicts.items()]
        return F.coalesce(*cases, F.lit(None).cast("string"))

    edges = page_links(pages, url, html).select("src", "dst") if html else None
    if links is not None:
        known = links.select("src", "dst")
        edges = known if edges is None else edges.unionByName(known)
    result = judged(pages, url).withColumn("__verdict", verdict(F.col("rule")))
    if edges is None:
        return result.withColumn("verdict", F.coalesce("__verdict", F.lit(default))).drop("__verdict")
    edges = stage(edges.where("src is not null and dst is not null").distinct(), "links")
    member = components(edges.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")))
    ends = edges.select(F.explode(F.array("src", "dst")).alias("u")).distinct()
    ruled = judged(ends, "u").select(node_of(F.col("u")).alias("node"), verdict(F.col("rule")).alias("v"))
    decided = (
        member.join(ruled.where("v is not null"), "node")
        .groupBy("root")
        # 'allow' sorts before 'block', so the least is the one that has precedence.
        .agg(F.min("v").alias("v"))
    )
    alias = stage(member.join(decided, "root").select(F.col("node").alias("__node"), F.col("v").alias("__alias")).distinct(), "aliases")
    return (
        # Only urls without a rule look for aliases; the others keep out of the join by a null key.
        result.withColumn("__node", F.when(F.col("rule").isNull(), node_of(F.col(url))))
        .join(alias, "__node", "left")
        .withColumn("verdict", F.coalesce("__verdict", "__alias", F.lit(default)))
        .drop("__node", "__verdict", "__alias")
    )
