"""Pages as the bytes that were fetched, to text."""

from __future__ import annotations

import codecs
import re

# The marks at the start of a text.
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xfe\xff", "utf-16-be"), (b"\xff\xfe", "utf-16-le"))
#: Of the page, where its own declaration is looked for.
DECLARED_WITHIN = 1024
_CHARSET = r"""charset\s*=\s*["']?\s*([A-Za-z0-9_:.\-]+)"""
_HEADER = re.compile(_CHARSET, re.I)
_META = re.compile(rb"<meta\b[^>]*?" + _CHARSET.encode(), re.I)


def codec(name: str | None) -> str | None:
    """Python's name of a declared charset; as browsers do, Latin-1 and ASCII are read as Windows-1252."""
    try:
        found = codecs.lookup(name or "")
    except LookupError:
        return None
    if not found._is_text_encoding:  # transforms such as base64 are no charsets
        return None
    return "cp1252" if found.name in ("iso8859-1", "ascii") else found.name


def declared(page: bytes, header: str | None) -> str | None:
    """The charset that the HTTP header names, else the one that the page names."""
    found = _HEADER.search(header or "")
    by_header = codec(found[1]) if found else None
    if by_header:
        return by_header
    found = _META.search(page[:DECLARED_WITHIN])
    by_page = codec(found[1].decode("ascii")) if found else None
    # it was read byte by byte, so it cannot be in words of two
    return "utf-8" if by_page and by_page.startswith("utf-16") else by_page


def decoded(page: bytes, header: str | None = None) -> str:
    """By a mark at the start, the declared charset, else UTF-8 if it is that, else Windows-1252.

    Bytes that the charset does not have become U+FFFD.
    """
    for mark, name in MARKS:
        if page.startswith(mark):
            return page[len(mark) :].decode(name, "replace")
    name = declared(page, header)
    if name:
        return page.decode(name, "replace")
    try:
        return page.decode("utf-8")
    except UnicodeDecodeError:
        return page.decode("cp1252", "replace")
