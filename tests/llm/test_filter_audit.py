import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from shopgrain.llm import filter_audit
from tests.llm.helpers import clashing, documents, rows_of

LABELS = "doc_id bigint, quality int, toxic int"
MEASURES = filter_audit.MEASURES

ROWS = [
    (1, "word " * 120, "en", "a", 1),  # fails B
    (2, " ".join(f"w{i}" for i in range(150)), "en", "a", 1),  # fails nothing
    (3, " ".join(f"w{i}" for i in range(150)), "en", "a", 1),  # the same text again: fails E
    (3, " ".join(f"w{i}" for i in range(150)), "de", "a", 1),  # a repeated id in another part
    (4, "A BIG SHOUT $", "en", "a", 1),  # fails A, C and D
    (5, "A BIG SHOUT $", "en", "a", 1),  # and E
    (5, "a a a", "de", "a", 1),  # an id with two texts
    (None, "A BIG SHOUT $", "de", "a", 1),  # a null id never fails E
    (None, "a a a", None, "a", 1),
    (6, None, None, None, None),
    (7, "", "", "a", 0),  # the same text as the null one
    (8, " \t\n\x0b\x0c\r ", "en", "a", 0),
    (9, "é É w x " * 60, "fr", "a", 0),  # only ASCII blanks part words
    (10, "X" * 9 + "x" * 81 + " ", "fr", "a", 0),
    (11, "long " * 40_000 + "| end", "fr", "a", 0),
]
LABEL_ROWS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (4, 0, 0), (4, None, 1), (5, 1, 0), (6, None, None), (None, 1, 1), (99, 1, 1)]


def expected(rows, labels):
    """Each order applied filter by filter to the documents themselves."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = defaultdict(list)
    for i, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ""
        failed += "A" * (len(words) < 100)
        failed += "B" * (100 * len(set(words)) < 80 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        failed += "D" * bool(re.search(r"[#$%&*|]", text))
        failed += "E" * (i is not None and text in first and first[text] < i)
        parts[lang or ""].append((failed, i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[0]]
                out[part, "".join(order), step] = [
                    len(left) - len(removed),
                    len(removed),
                    sum(f in d[0] for d in gone),
                    sum(d[0] == f for d in docs),
                    sum(d[1] for d in removed),
                    sum(d[2] for d in removed),
                ]
                shapley[f] += len(removed)
                left, gone = [d for d in left if f not in d[0]], gone + removed
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def found(df):
    return {(r.part, r.filter_order, r.step): [r[m] for m in MEASURES] for r in df.collect()}


def test_awkward_rows_against_filters_one_after_the_other(spark):
    docs, labels = documents(spark, ROWS), spark.createDataFrame(LABEL_ROWS, LABELS)
    audited = filter_audit.audit_filters(docs, labels)
    assert audited.columns == ["part", "filter_order", "step", *MEASURES]
    assert found(audited) == expected(ROWS, LABEL_ROWS)
    assert audited.count() == 4 * 600
    assert rows_of(filter_audit.audit_filters(clashing(docs), clashing(labels))) == rows_of(audited)


def test_empty_tables(spark):
    docs, labels = documents(spark, ROWS), spark.createDataFrame(LABEL_ROWS, LABELS)
    assert filter_audit.audit_filters(documents(spark, []), labels).collect() == []
    none = found(filter_audit.audit_filters(docs, labels.limit(0)))
    assert none == expected(ROWS, [])


def test_many_parts_and_a_hot_text(spark):
    """More parts than a batch takes; a third of all rows share one text and one part."""
    hot = [(i, "the same text", "hot", "a", 1) for i in range(400)]
    rest = [(1000 + i, f"text {i} $" if i % 3 else f"TEXT {i}", f"part {i % 150}", "a", 1) for i in range(800)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 1800, 7)]
    labels = [(i, int(q), int(t)) for i, q, t in labels]
    got = filter_audit.audit_filters(documents(spark, hot + rest), spark.createDataFrame(labels, LABELS))
    assert found(got) == expected(hot + rest, labels)


def test_contraction_against_loops():
    rng = np.random.default_rng(3)
    cells = rng.integers(0, 9, (3, 2, 32))
    got = filter_audit.audit_parts(*cells)
    orders = filter_audit.orders()
    for p in range(2):
        for o, order in enumerate(orders[::17]):
            for k, own in enumerate(order):
                at = 17 * o * 5 + k
                fails = [c for c in range(32) if c >> own & 1]
                removed = [c for c in fails if not any(c >> b & 1 for b in order[:k])]
                assert got["removed"][p, at] == cells[0, p, removed].sum()
                assert got["good_lost"][p, at] == cells[1, p, removed].sum()
                assert got["redundant"][p, at] == cells[0, p, fails].sum() - cells[0, p, removed].sum()
                assert got["unique_fails"][p, at] == cells[0, p, 1 << own]
