"""Near duplicates in one large group: what leaves the tasks, and the result."""

import random

import pytest

from paywatch.llm import superminhash


def shingles_of(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_copies(n, percent, seed=4):
    """Copies of one text with words changed, some linked at the threshold and many just below it."""
    dice = random.Random(seed)
    base = [f"w{i}" for i in range(240)]
    changes = {80: (3, 7), 85: (2, 5)}[percent]
    out = []
    for i in range(n):
        words = list(base)
        for k in dice.sample(range(240), dice.randint(*changes)):
            words[k] = f"x{dice.randrange(10**6)}"
        out.append((i, " ".join(words)))
    return out


def plain(rows, percent):
    sets = {i: shingles_of(t) for i, t in rows}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in sets:
        for k in sets:
            if i < k and 100 * len(sets[i] & sets[k]) >= percent * len(sets[i] | sets[k]):
                a, b = sorted((root(i), root(k)))
                name[b] = a
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_rows_written_grow_with_the_group_not_with_its_pairs(spark, monkeypatch, percent):
    written, write = {}, superminhash.materialize

    def counted(df, name):
        out = write(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(superminhash, "materialize", counted)
    monkeypatch.setattr(superminhash, "BLOCK", 64)
    sizes = []
    for n in (150, 300):
        written.clear()
        rows = near_copies(n, percent)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in superminhash.groups(docs, percent).collect()}
        assert got == plain(rows, percent)
        assert written["links"] < 4 * n
        sizes.append(sum(written.values()))
    assert sizes[1] < 3 * sizes[0]
