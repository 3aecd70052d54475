"""Links: joining, hosts, and the page a link leads to."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bare

#: Letters and digits in a page's code.
CODE_LENGTH = 10

_TAIL = r"(?:\.[a-z0-9]{1,5})?(?:/.*)?$"
_CODE = rf"(?s)^.*-([a-z0-9]{{{CODE_LENGTH}}}){_TAIL}"
#: Most links are written without anything odd and end in their code.
_PLAIN = rf"\A[A-Za-z0-9:/._-]*-[A-Za-z0-9]{{{CODE_LENGTH}}}\z"
_BARE = rf"(?s)^.*field-info/+([a-z0-9]{{{CODE_LENGTH}}}){_TAIL}"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def page_code(link: Column) -> Column:
    """The code of the page a link leads to, in lower case; null where it leads to none.

    The path's last name that ends in a code counts, so folders, print views, sub-pages and file endings around it are
    immaterial; query and fragment are cut before escapes are resolved. Malformed escapes are taken as they stand.
    """
    path = F.substring_index(F.substring_index(link, "?", 1), "#", 1)
    whole = lambda p: F.regexp_replace(p, "%(?![0-9A-Fa-f]{2})", "%25")  # noqa: E731  a broken escape must not spoil the others
    decoded = lambda p: F.coalesce(F.try_url_decode(F.replace(whole(p), F.lit("+"), F.lit("%2B"))), p)
    plain = _let(path, lambda p: F.when(F.contains(p, F.lit("%")), decoded(p)).otherwise(p))
    general = _let(
        F.lower(bare(plain)),
        lambda p: _let(F.regexp_extract(p, _CODE, 1), lambda c: F.when(c != "", c).when(F.contains(p, F.lit("field-info/")), F.nullif(F.regexp_extract(p, _BARE, 1), F.lit(""))))
    )
    return F.when(link.rlike(_PLAIN), F.lower(F.right(link, F.lit(CODE_LENGTH)))).otherwise(general)


_PY_CODE, _PY_BARE = re.compile(_CODE), re.compile(_BARE)
_PY_BLANK = re.compile(r"[\s\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]+")


def page_code_of(link: object) -> str | None:
    """``page_code`` for a Python value, for use inside Arrow passes; anything but a string has none."""
    if not isinstance(link, str):
        return None
    path = re.split("[?#]", link, maxsplit=1)[0]
    plain = _PY_BLANK.sub("", unquote(path) if "%" in path else path).lower()
    m = _PY_CODE.match(plain) or _PY_BARE.match(plain)
    return m[1] if m else None


def link_page_of(value: object) -> str | None:
    """``page_code_of`` for a value that may be any text: one with blanks inside or without a slash is no link."""
    if type(value) is not str or "/" not in value or "-" not in value:
        return None
    bare = _PY_BLANK.sub(" ", value).strip()
    return None if " " in bare else page_code_of(bare)


#: Schemes under which a reference without one is resolved against its base.
RELATIVE_SCHEMES = [
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp",
    "svn", "svn+ssh", "ws", "wss"
]


#: Fixed value: the regular expression of RFC 3986, appendix B, with schemes as that document has them.
URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?(?:#(.*))?$"


def _parts(url: Column) -> Column:
    """scheme, host, path, query, fragment of a URL; a part that isn't there is ``''``."""
    part = lambda k: F.regexp_extract(url, URL_PARTS, k)
    return F.struct(F.lower(part(1)).alias("scheme"), part(2).alias("host"), part(3).alias("path"), part(4).alias("query"), part(5).alias("fragment"))


def _merged(base: Column, path: Column) -> Column:
    """A path that isn't empty, on its base's path, without dot segments."""
    but_last = lambda x: F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0)))
    step = lambda done, x: F.when(x == "..", but_last(done)).when(x == ".", done).otherwise(F.array_append(done, x))
    # a base's last name doesn't count; where it is empty the folder's end stays as a segment, to be dropped as one
    folder = _let(F.split(base, "/"), lambda x: F.when(F.element_at(x, -1) == "", x).otherwise(but_last(x)))
    both = _let(F.concat(folder, F.split(path, "/")), lambda x: F.filter(x, lambda y, i: (i == 0) | (i == F.size(x) - 1) | (y != "")))
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(both)
    done = lambda x: F.aggregate(x, F.array().cast("array<string>"), step)
    text = _let(segments, lambda x: F.array_join(F.when(F.element_at(x, -1).isin(".", ".."), F.array_append(done(x), "")).otherwise(done(x)), "/"))
    return _let(text, lambda x: F.when(x == "", "/").otherwise(x))


def _text_of(scheme: Column, host: Column, path: Column, query: Column, fragment: Column) -> Column:
    there = lambda lead, x, end: F.when(x != "", F.concat(F.lit(lead), x, F.lit(end))).otherwise("")
    rooted = _let(path, lambda x: F.when((host != "") & (x != "") & ~x.startswith("/"), F.concat(F.lit("/"), x)).otherwise(x))
    return F.concat(there("", scheme, ":"), there("//", host, ""), rooted, there("?", query, ""), there("#", fragment, ""))


def _resolved(b: Column, r: Column, ref: Column) -> Column:
    """``ref``, whose parts are ``r``, on a base whose parts are ``b``."""
    scheme = F.when(r["scheme"] != "", r["scheme"]).otherwise(b["scheme"])
    broken = F.contains(r["host"], F.lit("[")) != F.contains(r["host"], F.lit("]"))
    bare = (r["host"] == "") & (r["path"] == "")
    path = F.when(r["host"] != "", r["path"]).when(bare, b["path"]).otherwise(_merged(b["path"], r["path"]))
    query = F.when(bare & (r["query"] == ""), b["query"]).otherwise(r["query"])
    host = F.when(r["host"] != "", r["host"]).otherwise(b["host"])
    return F.when(
        (scheme != b["scheme"]) | ~scheme.isin(RELATIVE_SCHEMES) | broken, ref
    ).otherwise(_text_of(scheme, host, path, query, r["fragment"]))


def url_join(base: Column, ref: Column) -> Column:
    """RFC 3986 join, of built-in expressions only.

    A null or empty reference is the base itself, and without a base the reference comes back. Blanks and control
    characters before a reference and tabs and line ends in it go, empty queries and fragments too. Semicolons have no
    meaning of their own. A reference with a broken bracketed host comes back unchanged.
    """
    base, ref = F.coalesce(base, F.lit("")), F.coalesce(ref, F.lit(""))
    tidy = lambda c: F.when(c.rlike(r"^[\x00-\x20]|[\t\r\n]"), F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")).otherwise(c)
    general = _let(F.struct(_let(tidy(base), _parts).alias("b"), _let(tidy(ref), _parts).alias("r")), lambda x: _resolved(x["b"], x["r"], ref))
    # the common case, a path of its own without dots, needs no parts
    origin = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    odd = ref.rlike(r"(^|/)\.{1,2}(/|$|[?#])|[?#]$|[?]#|[\t\r\n]")
    rooted = ref.rlike(r"^/[^/]") & ~odd & (origin != "")
    return F.when(ref == "", base).when(base == "", ref).when(rooted, F.concat(origin, ref)).otherwise(general)


def absolutize(base: Column, link: Column) -> Column:
    """Links that start with ``http`` as they are, others joined to ``base``; the test comes before any strip."""
    return F.when(link.startswith("http"), link).otherwise(url_join(base, link))


def host_in(url: Column, domain: str) -> Column:
    """Whether the URL's host is ``domain`` or below it; false for what has no host."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?=[/?#:]|$)", 1)
    return F.coalesce((host == domain) | host.endswith("." + domain), F.lit(False))
