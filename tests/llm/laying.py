"""Every item laid over every word of every document, without seeds."""

import re

from snipmill.llm import decontaminate as d

WORD = re.compile(d.WORD)


def every_laying(docs, items, percent=75, window=13):
    """Most equal words of a stretch and number of layings, without seeds."""
    split = lambda t: WORD.findall((t or "").lower())
    found = {}
    for i, text in docs:
        w = split(text)
        for k, item in items:
            v = split(item)
            n = min(window, len(v))
            for begin in range(1 - len(v), len(w)) if n else ():
                equal = [0 <= j + begin < len(w) and w[j + begin] == v[j] for j in range(len(v))]
                inside = range(max(0, -begin), min(len(v), len(w) - begin) - n + 1)
                most = max((sum(equal[s : s + n]) for s in inside), default=0)
                if inside and 100 * most >= percent * n:
                    found.setdefault((i, k), []).append(most)
    return {key: (max(at), len(at)) for key, at in found.items()}
