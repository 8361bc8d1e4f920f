"""The grouping rules written out plainly, to compare the Spark job with."""

from __future__ import annotations

import math

import regex

SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
TOKEN = regex.compile(rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE}]")
SPACED = regex.compile(rf"(?:[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE}])[{SPACE}]*")


def count(text):
    return len(TOKEN.findall(text))


def similarity(a, b):
    size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b)) / size if size else 0.0


def chunks(elements, low, high, ratio=0.0, threshold=None, vectors=None):
    """[(index, text, title, kind, element count)] of elements (type, text)."""
    groups, parts, size, start_title, centre, heading = [], [], 0, None, None, None

    def text_of(pieces):
        return "\n\n".join(p for p in pieces if p.strip())

    def close():
        nonlocal parts, size, centre
        groups.append((text_of(parts), start_title, "text", len(parts)))
        parts, size, centre = [], 0, None

    for at, (kind, text) in enumerate(elements):
        if kind != "Image" and not text.strip():
            continue
        tokens = count(text)
        if kind == "Title":
            heading = text
            if threshold is None and parts and size >= low:
                close()
        if kind in ("Table", "Image"):
            if parts:
                close()
            groups.append((text, heading, kind.lower(), 1))
            continue
        if not parts:
            split = False
        elif threshold is None:
            split = size + tokens > high and size >= low
        else:
            alike = similarity(centre, vectors[at])
            split = (alike < threshold or size + tokens > high) and not (size < low and alike >= 0.5)
        if split:
            before = text_of(parts)
            close()
            pieces = SPACED.findall(before)
            repeat = int(len(pieces) * ratio)
            if repeat > 0:
                again = "".join(pieces[-repeat:]).strip()
                parts, size = ["[...] " + again], count(again)
            centre = vectors[at] if vectors else None
            start_title = heading
        elif not parts:
            start_title = heading
            centre = vectors[at] if vectors else None
        elif vectors:
            n = len(parts) + 1
            centre = [(c * (n - 1) + v) / n for c, v in zip(centre, vectors[at])]
        parts.append(text)
        size += tokens
    if parts:
        close()
    return [(i, *g) for i, g in enumerate(groups) if g[0].strip()]
