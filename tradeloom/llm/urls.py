"""URL filters with redirect equivalence.

Rules name a host and a path prefix; the longest that fits decides. Redirects (meta refresh) and
canonical links of pages make URLs equivalent: connected components over these edges carry a block to
every alias that has no rule of its own. A URL's own rule always wins, so an explicit allow takes
precedence over a block that arrives through an alias.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.components import connected_components
from tradeloom.operators.matching import join_side_keys

Rule = tuple[str, str, str]  # verdict, host, path prefix


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty if there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text like `org/`, and its verdict; NULL if none fits.

    The more specific host is the longer rule, then the longer path; a block beats an allow of equal length.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last condition applied is the outermost, so the longest rule comes last.
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _place(url: Column) -> Column:
    """What identifies a URL's resource: host, path and query, without scheme and fragment."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?", 1)
    path = path_of(url)
    return F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query)


# A quoted value ends at its closing quote, whatever signs it holds; other quotes are signs like others.
_VALUE = r"""\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++)"""
_TAG = re.compile(r"""<(link|meta|base)\b((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""", re.I)
_ATTRIBUTE = re.compile(rf"([^\s>=/\"']++)(?:{_VALUE})?+")
_ENTITY = re.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);")
_REFRESH = re.compile(r"\s*[\d.]*\s*[;,\s]\s*(?:url\s*=\s*)?(.*)", re.I | re.S)
_BROKEN = re.compile(r"""\burl\s*=\s*["']?([^"'>\s]+)""", re.I)
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def _decoded(text: str) -> str:
    """`text` with its entities replaced; an `&name` without semicolon may be part of a query and stays."""
    return _ENTITY.sub(lambda found: html.unescape(found[0]), text)


def _attributes(tag: str) -> dict[str, str]:
    """A tag's attributes, of equal ones the first, with their entities decoded."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(tag):
        value = value[1:-1] if len(value) > 1 and value[0] in "\"'" and value[0] == value[-1] else value
        found.setdefault(name.lower(), _decoded(value))
    return found


def _redirect(content: str, tag: str) -> str:
    """The target of a refresh; behind quotes within equal quotes, which end `content` early, as well."""
    found = _REFRESH.fullmatch(content)
    target = found[1].strip() if found else ""
    if target[:1] in ("'", '"'):
        target = target[1:].split(target[0])[0]
    if not target and (broken := _BROKEN.search(tag)):
        target = _decoded(broken[1])
    return target


def _resolved(base: str, link: str) -> str | None:
    """`link` as found on a page with the base URL `base`; links of other kinds (`mailto:`) give None."""
    link = re.sub(r"[\t\r\n]", "", link).strip(" ").replace(" ", "%20")
    if not link or _SCHEME.match(link):
        return link if "://" in link[: link.find("/") + 2] else None
    try:
        return urljoin(base, link)
    except ValueError:  # no host could be read
        return None


def page_links(url: str, page: str) -> list[str]:
    """All canonical links and refresh targets of a page, resolved against its first `<base href>` or its URL."""
    base, links = None, []
    for kind, tag in _TAG.findall(page):
        has = _attributes(tag)
        if kind.lower() == "base":
            base = base or (_resolved(url, has["href"]) if "href" in has else None)
        elif kind.lower() == "link":
            links += [has["href"]] if "canonical" in has.get("rel", "").lower().split() and "href" in has else []
        elif has.get("http-equiv", "").strip().lower() == "refresh":
            links.append(_redirect(has.get("content", ""), tag))
    return [target for link in links if (target := _resolved(base or url, link))]


def _targets(batches):
    for batch in batches:
        pairs = [
            (url, target)
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())
            for target in page_links(url, page)
        ]
        columns = [pa.array([p[k] for p in pairs], pa.string()) for k in range(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["url", "target"])


def aliases(pages: DataFrame) -> DataFrame:
    """(here, there): places of each page and of its canonical links and its redirects, where it has them."""
    page = F.col("html").cast("string")
    # Only pages that may have such tags are handed to Python.
    some = pages.filter(F.col("url").contains("://") & page.rlike(r"(?i)<link\b|http-equiv"))
    targets = some.select("url", page.alias("html")).mapInArrow(_targets, "url string, target string")
    targets = targets.filter(F.col("target").contains("://"))
    edges = targets.select(_place(F.col("url")).alias("here"), _place(F.col("target")).alias("there"))
    return edges.filter("here <> there").distinct()


def blocked_places(edges: DataFrame, rules: list[Rule]) -> DataFrame:
    """(place): every place of `edges` in whose component a place is blocked by a rule.

    Rules look at host and path. Places are told apart by two 64-bit hashes, of which the first numbers
    the graph's nodes.
    """
    nodes = edges.select(F.explode(F.array("here", "there")).alias("place")).distinct()
    nodes = nodes.withColumn("node", F.xxhash64("place"))
    joined = connected_components(edges.select(F.xxhash64("here").alias("a"), F.xxhash64("there").alias("b")))
    url = F.concat(F.lit("x://"), F.col("place"))
    _, verdict = rule_of(host_of(url), path_of(url), rules)
    labelled = nodes.join(joined, "node").withColumn("blocked", verdict == "block")
    bad = labelled.filter("blocked").groupBy(*join_side_keys("component")).agg(F.lit(True).alias("bad"))
    return labelled.join(bad.select("component"), "component").select("place")


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, host, path, rule, verdict.

    The verdict is the rule's; without a rule it is `block` if the page's component of redirects and
    canonical links holds a URL that a rule blocks, else `allow`. URLs that are NULL or lack `://` have
    an empty host and path, fit no rule, and are allowed. NULL html has no links. Links may be relative to
    the page or its `<base href>`; all canonical and refresh tags count. Any page_id is passed
    through, NULL too; repeated rows give repeated results; other columns are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = (
        pages.select("page_id", host.alias("host"), path.alias("path"), _place(F.col("url")).alias("place"), "url")
        .withColumns({"rule": name, "own": verdict})
        .withColumn("place", F.when(F.col("url").contains("://"), F.col("place")))
    )
    bad = blocked_places(aliases(pages), rules).groupBy(*join_side_keys("place")).agg(F.lit("block").alias("through"))
    found = judged.join(bad.select("place", "through"), "place", "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("own", "through", F.lit("allow")).alias("verdict"))
