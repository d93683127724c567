"""Plain form of page identifiers and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The folders under which manuals lie and the host of the site.
PAGE_ROOTS = ("internal-manuals", "guidance")
SITE_HOST = "www.manuals.example"

#: What people and models leave around an identifier: blanks of any kind, brackets, quotes, list punctuation.
_EDGE = r"^[\s\p{Z}\[\](){}<>\"'`,;.]+|[\s\p{Z}\[\](){}<>\"'`,;.]+$"


def blank_trim(c: Column) -> Column:
    """Without blanks at the ends, no-break and zero-width ones included; null stays null."""
    return F.regexp_replace(c, r"^[\s\p{Z}\u200B\uFEFF]+|[\s\p{Z}\u200B\uFEFF]+$", "")


def _none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def last_segment(path: Column) -> Column:
    """Last segment of a path without fragment, query and closing slashes, in lower case; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(blank_trim(path), r"[?#].*$", ""), r"/+$", "")
    return _none_if_empty(F.lower(F.element_at(F.split(bare, "/"), -1)))


def node_id(section_id: Column, base_path: Column) -> Column:
    """Node id from an identifier, or from the path where there is none."""
    return F.coalesce(last_segment(section_id), last_segment(base_path))


def href_target(href: Column, roots: tuple[str, ...] = PAGE_ROOTS, host: str = SITE_HOST) -> Column:
    """Node id an href refers to, or null if it doesn't name a page below a manual on this site.

    A bare identifier (letters, then digits) counts, and a path of at least two further segments under one of
    the roots, without host or on the given one.
    """
    bare = F.regexp_replace(F.regexp_replace(blank_trim(href), r"[?#].*$", ""), r"/+$", "")
    host_re = host.replace(".", r"\.")
    path_re = rf"(?i)^(?:(?:https?:)?//{host_re}(?::\d+)?)?/(?:{'|'.join(roots)})/[^/]+/(?:[^/]+/)*[^/]+$"
    return F.when(bare.rlike(r"^[A-Za-z]+\d+[A-Za-z]?$") | bare.rlike(path_re), last_segment(bare))


def mention_target(c: Column) -> Column:
    """Node id out of an identifier as a model writes it: bracketed, padded, in any case, or a path."""
    return last_segment(F.regexp_replace(c, _EDGE, ""))
