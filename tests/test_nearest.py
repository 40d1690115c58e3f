"""The search for the most similar texts against comparing all of them."""

import difflib
import random

import pandas as pd

from tidewire.operators import nearest


def test_nearest_against_all_pairs(monkeypatch):
    """The best by path and title are those of comparing all pairs, of which few are aligned."""
    rng = random.Random(3)
    parts = [["rates", "oil", "copper", "harvest", "budget", "fleet"], ["rise", "fall", "worry", "leave"], [f"lenders{i}" for i in range(25)], ["in ulkast", "in novaast", ""]]
    title = lambda: " ".join(rng.choice(p) for p in parts).strip()
    known = [(f"https://a.b/{i}", "/" if i == 7 else f"/news/2025/{rng.randint(1, 12):02}/{t.replace(' ', '-')[:30]}-{i:05}.html", t if i % 9 else None) for i, t in enumerate(title() for _ in range(250))]
    wanted = [(f"w{i}", k[1][:-11] + ".html" if i % 3 else f"/x/{title()}", (k[2] if i % 4 else title() * (1 + i % 5)) if i % 11 else None) for i, k in enumerate(rng.sample(known, 120))]
    words = lambda t: None if t is None else " ".join(dict.fromkeys(x for x in t.split() if len(x) > 3))
    left = pd.DataFrame([(r, p, t, words(t)) for r, p, t in wanted], columns=["raw_url", "p", "hl", "hw"])
    right = pd.DataFrame([(u, q, t, words(t)) for u, q, t in known], columns=["url", "q", "title", "tw"])

    def title_score(a, b, least):
        r = difflib.SequenceMatcher(None, a, b).ratio()
        own = words(a).split()
        return max(r if r >= least else 0.0, 0.7 * (len(set(own) & set(words(b).split())) / len(own) if own else 0.0))

    paths, titles = {}, {}
    for raw, p, hl in wanted:
        for url, q, t in known:
            r = difflib.SequenceMatcher(None, p, q).ratio()
            r = max(r, 0.82) if p in q or q in p else r
            score = min(1.0, r * (0.55 + 0.45 * title_score(hl, t, 0.0))) if hl and t else r
            if r >= 0.72 and score >= 0.72:
                paths[raw] = min(paths.get(raw, (0.0, "")), (-score, url))
            if hl and t and title_score(hl, t, 0.48) >= 0.48:
                titles[raw] = min(titles.get(raw, (0.0, "")), (-title_score(hl, t, 0.48), url))
    calls, align = [], nearest.ratio
    monkeypatch.setattr(nearest, "ratio", lambda *x: calls.append(1) or align(*x))
    got = {r.raw_url: (-r.score, r.url) for r in nearest.by_path(0.72, 0.82)((), left, right).itertuples()}
    assert got == paths and len(paths) > 60
    heads, given = right[right["title"].notna()], left[left["hl"].notna()]
    got = {r.raw_url: (-r.score, r.url) for r in nearest.by_title(0.48)((), given, heads).itertuples()}
    assert got == titles and len(titles) > 60
    assert len(calls) < 0.1 * 2 * len(wanted) * len(known)
