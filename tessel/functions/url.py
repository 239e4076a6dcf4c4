"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track.
TRACKING = "^(utm_|fbclid|gclid|gad_|ref$|preview$|affiliateid$)"
#: Names that never leave their own network.
INTERNAL = r"\.(localhost|local|internal|lan|home|corp|intranet)$"

_SPLIT = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, _SPLIT, i)


def host(url: Column) -> Column:
    """Lower-case host without user, port; empty if there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(_part(url, 2), r"^[^@]*@", ""), r":\d*$", ""))


def is_http(url: Column) -> Column:
    return F.coalesce(F.lower(_part(url, 1)).isin("http", "https") & (host(url) != ""), F.lit(False))


def canonical(url: Column, keep_hash: bool = False) -> Column:
    """Without fragment and tracking parameters; scheme and host in lower case, no default port, a path at least '/'."""
    scheme = F.lower(_part(url, 1))
    place = F.lower(_part(url, 2))
    place = F.when(scheme == "http", F.regexp_replace(place, ":80$", "")).when(scheme == "https", F.regexp_replace(place, ":443$", "")).otherwise(place)
    path = F.when(_part(url, 3) == "", "/").otherwise(_part(url, 3))
    params = F.split(F.regexp_replace(_part(url, 4), r"^\?", ""), "&", -1)
    kept = F.array_join(F.filter(params, lambda p: ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).rlike(TRACKING)), "&")
    query = F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))
    fragment = _part(url, 5)
    shown = F.when(fragment.isin("", "#", "#/"), "").otherwise(fragment) if keep_hash else F.lit("")
    return F.when(url.rlike(_SPLIT), F.concat(scheme, F.lit("://"), place, path, query, shown))


def is_public(name: Column) -> Column:
    """Whether a host may be reached: no internal name, IPv6 literal, or private, loopback, link-local or shared IPv4."""
    h = F.regexp_replace(F.lower(name), r"\.$", "")
    quad = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"
    a, b = (F.when(h.rlike(quad), F.regexp_extract(h, quad, i)).otherwise("999").cast("int") for i in (1, 2))
    closed = a.isin(0, 10, 127) | ((a >= 224) & (a != 999)) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 100) & b.between(64, 127))
    name_closed = (h == "") | h.startswith("[") | h.contains(":") | (h == "localhost") | h.rlike(INTERNAL)
    return ~(name_closed | (h.rlike(quad) & closed))


def same_site(name: Column, allowed: Column) -> Column:
    """Equal hosts, or the first a subdomain of the second; a leading www. doesn't count."""
    h, a = (F.regexp_replace(F.lower(x), r"^www\.", "") for x in (name, allowed))
    return (h == a) | h.endswith(F.concat(F.lit("."), a))


def same_host(a: Column, b: Column) -> Column:
    """Equal hosts of two URLs, a leading www. aside."""
    x, y = (F.regexp_replace(host(u), r"^www\.", "") for u in (a, b))
    return (x != "") & (x == y)
