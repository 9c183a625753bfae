"""Items of a large JSON document, one at a time, in bounded memory."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

#: A whole string, or a sign that opens, closes or parts values. UTF-8 keeps these bytes out of its longer characters.
TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+"|[\[\]{}:,]', re.DOTALL)
SIGN = re.compile(rb'[\[\]{}:,"]')
#: What is passed over in one step below the document's own fields: numbers, whole strings, lists of numbers.
RUN = re.compile(rb'(?:[^\[\]{}"]++|\[[^\[\]{}"]*+\]|"(?:[^"\\]++|\\.)*+")++', re.DOTALL)


def items(chunks: Iterable[bytes], key: str) -> Iterator[bytes]:
    """Each object of the list that a document's own field `key` holds, as its bytes.

    The document comes in pieces of any size, in UTF-8, with or without a byte-order mark. Of it no more is held than an item
    and a piece. Lists of that name further down don't count, items that are no objects are passed over. A document without
    such a list has no items; one that ends too early is an error.
    """
    name, held, at, start, opened = key.encode(), b"", 0, None, []
    last, field, inside = None, None, False
    for chunk in chunks:
        # What came before the item under way, or before the token under way, isn't needed again.
        keep = at if start is None else start
        held, at, start = held[keep:] + chunk, at - keep, None if start is None else 0
        while True:
            if len(opened) > 1 and (run := RUN.match(held, at)):
                at = run.end()
            found = SIGN.search(held, at)
            if found is None:
                at = len(held)
                break
            token = TOKEN.match(held, found.start())
            if token is None:  # a string that the next piece goes on with
                at = found.start()
                break
            at, sign = token.end(), token.group()
            if sign in (b"{", b"["):
                if len(opened) == 1 and opened[0] == b"{" and sign == b"[" and field == name:
                    inside = True
                elif inside and len(opened) == 2 and sign == b"{":
                    start = token.start()
                opened.append(sign)
            elif sign in (b"}", b"]"):
                if not opened or (opened.pop() == b"{") != (sign == b"}"):
                    raise ValueError("brackets that don't match")
                if inside and len(opened) == 2 and start is not None:
                    yield held[start:at]
                    start = None
                elif len(opened) == 1:
                    inside, field = False, None
            elif len(opened) == 1:
                field = last if sign == b":" else None if sign == b"," else field
                last = sign[1:-1] if sign[:1] == b'"' else last
    if opened or held[at:].strip():
        raise ValueError("the document ends too early")
