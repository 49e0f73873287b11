"""Web addresses and their owners' hosts as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from ipaddress import ip_address
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import let

# Second-level labels under which names are registered.
TWO_LABEL_SUFFIXES = (
    "co.uk org.uk ac.uk gov.uk ltd.uk plc.uk me.uk com.au net.au org.au edu.au co.nz org.nz net.nz co.jp or.jp ne.jp ac.jp "
    "com.br net.br org.br com.mx org.mx co.in net.in org.in co.za org.za com.cn net.cn org.cn com.tw com.hk com.sg co.kr com.tr com.ar co.il"
).split()
# Hosts that lend pages or subdomains, and mail services; a subdomain of them is nobody's own site.
SHARED_HOSTS = (
    "facebook.com linkedin.com instagram.com twitter.com x.com youtube.com yelp.com yellowpages.com google.com sites.google.com "
    "wixsite.com wordpress.com blogspot.com weebly.com squarespace.com godaddysites.com business.site github.io etsy.com ebay.com amazon.com "
    "gmail.com yahoo.com hotmail.com outlook.com aol.com icloud.com"
).split()


def host_of(c: Column) -> Column:
    """Host of a web address without scheme, port, path, www and outer dots; null for mail addresses and for what is no host."""
    authority = F.regexp_extract(F.lower(F.trim(c)), "^(?:(?:[a-z][a-z0-9+.-]*:)?//)?([^/?#]*)", 1)

    def host(a: Column) -> Column:
        bare = F.btrim(F.regexp_extract(a, "^([^:\\s]*)", 1), F.lit("."))
        own = F.when(bare.startswith("www"), F.regexp_replace(bare, "^www\\d*\\.", "")).otherwise(bare)
        return let(own, lambda h: F.when(~a.contains("@") & h.rlike("^([a-z0-9]([a-z0-9_-]*[a-z0-9])?\\.)+[a-z]{2,}$"), h))

    return let(authority, host)


def registrable(host: Column) -> Column:
    """The part of a host that someone registered: its last two labels, or three under a two-label suffix; null for less."""

    def part(labels: Column) -> Column:
        n = F.size(labels)
        two = F.concat_ws(".", F.get(labels, n - 2), F.get(labels, n - 1))
        return F.when(~two.isin(*TWO_LABEL_SUFFIXES), F.when(n >= 2, two)).when(n >= 3, F.concat_ws(".", F.get(labels, n - 3), two))

    return let(F.split(host, "\\."), part)


def own_domain(c: Column, platforms: Sequence[str] = ()) -> Column:
    """Registrable domain of a company's own web address; null for platforms, shared hosts, mail addresses and fillers."""
    shared = [*SHARED_HOSTS, *platforms]
    return let(host_of(c), lambda host: F.when(~host.isin(*shared), let(registrable(host), lambda d: F.when(~d.isin(*shared), d))))


def homepages(domain: Column) -> Column:
    """Addresses under which a domain's first page may be, in the order to try them."""
    return F.array(*[F.concat(F.lit(head), domain, F.lit("/")) for head in ("https://", "https://www.", "http://")])


def is_local(url: str) -> bool:
    """Whether a service's address is this very machine's, by name or number; names are not looked up."""
    host = (urlsplit(url).hostname or "").lower()
    try:
        return host == "localhost" or ip_address(host).is_loopback
    except ValueError:
        return False
