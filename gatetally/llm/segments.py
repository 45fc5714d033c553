"""Segments of a text that a piece vocabulary with word starts encodes on their own.

White space is written as U+2581 and put before every text. A piece holds that
sign only at its start or throughout, and no piece of several characters holds a
line break; so nothing merges across the start of a run of signs or on either
side of a line break. A segment is such a run with the word behind it, or a line
break with what follows it.
"""

from __future__ import annotations

import re

SIGN = "▁"
_SEGMENT = re.compile("▁+[^▁\n]*|\n[^▁\n]*")


def segment_keys(text: str) -> list[str]:
    """Keys of the segments of ``text``, in order; ``segment_of`` gives their characters."""
    if not text:
        return []
    if "  " in text or " \n" in text or text[0] == " " or SIGN in text:
        found = _SEGMENT.findall(SIGN + text.replace(" ", SIGN))
        return [s[1:] if s[0] == SIGN else s for s in found]
    return text.replace("\n", " \n").split(" ")


def segment_of(key: str) -> str:
    """The characters of a segment: the key with its leading sign, unless a line break leads."""
    return key if key[:1] == "\n" else SIGN + key
