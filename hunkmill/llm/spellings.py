"""One spelling for pull requests, files of a repository and logins.

All three are column expressions that stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that a reader can't see or sees as a space.
UNSEEN = r"\s\u00a0\u00ad\u200b-\u200f\u2000-\u200a\u202f\u205f\u2060\u3000\ufeff"


def squeeze(text: Column) -> Column:
    """Without white space and invisible characters at either end, nor invisible ones inside."""
    inner = F.regexp_replace(text, r"[\u00ad\u200b-\u200f\u2060\ufeff]", "")
    return F.regexp_replace(inner, f"^[{UNSEEN}]+|[{UNSEEN}]+$", "")


def pull_request(url: Column) -> Column:
    """``owner/name#number`` in lower case from any API or web address of a pull request.

    Host, scheme, query, fragment, trailing parts and leading zeros don't matter.  A text that
    is no such address stands for itself, squeezed, in lower case; null and blank give null.
    """
    s = F.lower(squeeze(url))
    shape = r"(?:^|/)([^/\s?#]+)/([^/\s?#]+)/(?:pulls?|issues?)/0*([0-9]+)(?:[/?#].*)?$"
    key = F.concat(
        F.regexp_extract(s, shape, 1), F.lit("/"), F.regexp_extract(s, shape, 2), F.lit("#"), F.regexp_extract(s, shape, 3)
    )
    return F.when(s.rlike(shape), key).when(s != "", s)


def repository(url: Column) -> Column:
    """The ``owner/name`` of :func:`pull_request`; null if the address has none."""
    key = pull_request(url)
    return F.when(key.rlike(r"^[^/#]+/[^/#]+#[0-9]+$"), F.substring_index(key, "#", 1))


def file_path(path: Column) -> Column:
    """A path inside a repository: forward slashes, no ``.`` parts, no leading ``/``, ``a/`` or ``b/``.

    The one-letter heads are what a diff puts before its paths.  Letter case counts.  Null and
    blank give null.
    """
    s = F.regexp_replace(F.regexp_replace(squeeze(path), r"\\", "/"), "/+", "/")
    s = F.regexp_replace(F.regexp_replace(s, r"/(?:\./)+", "/"), r"^(?:\.?/)+", "")
    s = F.regexp_replace(s, "^[ab]/", "")
    return F.when(s != "", s)


def login(name: Column) -> Column:
    """An account's login: squeezed, without a leading ``@``, in lower case; null if nothing is left."""
    s = F.lower(squeeze(F.regexp_replace(squeeze(name), "^@+", "")))
    return F.when(s != "", s)
