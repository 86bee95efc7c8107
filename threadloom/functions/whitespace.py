"""One spelling of Unicode white space for every pattern in the package."""

from __future__ import annotations

# The characters Python's str.split/str.strip treat as blank.
# Java's \s is ASCII only, so the class is always written out.
BLANK_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{BLANK_CLASS}]"
NOT_WS = f"[^{BLANK_CLASS}]"

WS_CHARS = "".join(chr(point) for point in range(0x3001) if chr(point).isspace())
