"""Terms of a text: runs of ASCII letters (and digits), lower-cased, and of anything beyond ASCII."""

from __future__ import annotations

SPACE = 0x20


def term_bytes(digits: bool) -> bytes:
    """Table for ``bytes.translate``: A-Z lower-cased, what is no part of a term made a space."""
    def to(b: int) -> int:
        c = chr(b)
        if b >= 0x80 or "a" <= c <= "z" or digits and "0" <= c <= "9":
            return b
        return b + 32 if "A" <= c <= "Z" else SPACE
    return bytes(to(b) for b in range(256))


WITH_DIGITS, LETTERS = term_bytes(True), term_bytes(False)


def terms_of(text: str | None, table: bytes) -> list[bytes]:
    """The terms in order, in UTF-8; a null text has none."""
    return text.encode().translate(table).split() if text else []
