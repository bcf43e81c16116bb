"""Terms of a text as UTF-8 bytes, A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

_LETTERS = set(range(65, 91)) | set(range(97, 123)) | set(range(128, 256))


def term_table(extra: bytes = b"") -> bytes:
    """For ``bytes.translate``: letters and ``extra`` stay, A-Z lower-cased; all other ASCII turns into a space."""
    kept = _LETTERS | set(extra)
    return bytes((b + 32 if 65 <= b < 91 else b) if b in kept else 32 for b in range(256))


def term_lists(text: str | None, table: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """All terms of the text in order, some at a time, so that a very long text needs little memory.

    Characters beyond ASCII are part of terms.  A null text has none.
    """
    data = (text or "").encode("utf-8", "surrogatepass").translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + step)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
