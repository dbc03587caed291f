"""Small tables with everything that can be odd in them, and brute-force forms."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " \
       "_ld_key string, size long, rank int, digest string, n_words long"


def prose(seed, n, vocabulary=400):
    state, out = seed * 7919 + 13, []
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(f"w{(state >> 33) % vocabulary:x}")
    return " ".join(out)


def odd_documents(spark, empty=False):
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, repeated ids, and extra columns whose names clash with inner ones."""
    texts = [
        (1, prose(1, 120)), (2, prose(2, 60)), (3, prose(1, 120)), (3, prose(1, 120)),
        (4, prose(1, 118) + " x y"), (5, None), (6, ""), (7, " \n\t "), (None, prose(1, 120)),
        (None, prose(9, 30)), (8, prose(8, 30000, 50000)), (9, "one two three"),
        (10, "one two three"), (11, "A b c"), (2, prose(12, 40)), (12, "\n\n\nword\n\n"),
        (13, prose(13, 70) + "\n" + prose(14, 80)), (14, prose(15, 30) + "\n" + prose(14, 80)),
        (15, "Ünïcödé ΣΑΣ \U0001f600 'tis don't 12,345 " + prose(16, 40))]
    rows = [] if empty else [
        (i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}",
         None if k % 3 == 0 else len(t or ""), "k", 5, 1, "d", None)
        for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def shingles(text):
    w = [x for x in WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))]
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else (tuple(w[i:i + 5]) for i in range(len(w) - 4)))


def classes(rows, percent=75):
    """(doc_id, set size, smallest reachable id) per row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= percent * max(
                    len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (low.get(r) is None or d < low[r]):
            low[r] = d
    return [(d, len(sets[i]), d if not sets[i] else low.get(find(i)))
            for i, (d, _) in enumerate(rows)]


def key(row):
    return tuple((x is None, x) for x in row)
