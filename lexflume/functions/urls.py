"""URL expressions."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, urlencode

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parameters that only track, besides utm_*.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid")
#: Path of a press release.
ARTICLE_PATH = r"(?i)/(?:newsroom/press-releases|news/press-release)/(?:19|20)\d{2}-\d+"


_URL = re.compile(r"(?:(?P<scheme>[A-Za-z][A-Za-z0-9+.-]*)://)?(?P<host>[^/?#]*)(?P<path>[^?#]*)(?:\?(?P<query>[^#]*))?(?:#.*)?", re.S)


def _tracks(pair: tuple[str, str]) -> bool:
    name = pair[0].lower()
    return name in TRACKING or name.startswith("utm_")


def canonical_one(value: object) -> str:
    """Scheme and host in lower case, no tracking parameters, no fragment, no trailing slash but for the root.

    What has no host, or brackets that don't hold one, stays as it is.
    """
    raw = str(value or "").strip()
    found = _URL.fullmatch(raw)
    host = found["host"].lower() if found else ""
    if not host or host.count("[") != host.count("]") or ("://" in raw and not found["scheme"]):
        return raw
    path = found["path"].rstrip("/") or found["path"][:1] * (found["path"] == "/")
    query = urlencode([p for p in parse_qsl(found["query"] or "", keep_blank_values=True) if not _tracks(p)])
    return f"{(found['scheme'] or 'https').lower()}://{host}{path}" + (f"?{query}" if query else "")


@F.pandas_udf(T.StringType())
def canonical_url(urls: pd.Series) -> pd.Series:
    return urls.map(canonical_one)


def host(c: Column) -> Column:
    return F.lower(F.try_parse_url(c, F.lit("HOST")))


def domain(c: Column) -> Column:
    """Network location in lower case without www.; '<INVALID_OR_MISSING>' if there is none."""
    netloc = F.regexp_replace(F.lower(F.try_parse_url(c, F.lit("AUTHORITY"))), r"^www\.", "")
    return F.coalesce(F.nullif(netloc, F.lit("")), F.lit("<INVALID_OR_MISSING>"))


def host_allowed(c: Column, hosts: list[str]) -> Column:
    return F.coalesce(host(c).isin(hosts), F.lit(False))


def is_article(c: Column) -> Column:
    return F.coalesce(F.try_parse_url(c, F.lit("PATH")).rlike(ARTICLE_PATH), F.lit(False))
