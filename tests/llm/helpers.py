"""Comparing a registered query with its SQL on one data folder."""

from collections import Counter

from clickweir.llm.oracle import ORACLE_SQL
from clickweir.llm.queries import QUERIES
from clickweir.parity.compare import oracle_connection


def compare(spark, name, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    names = sorted(frame.columns)
    ours = [tuple(r[c] for c in names) for r in frame.collect()]
    answer = oracle_connection(sf_dir).execute(ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    theirs = [tuple(row[columns.index(c)] for c in names) for row in answer.fetchall()]

    def rounded(rows):
        return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)

    a, b = rounded(ours), rounded(theirs)
    assert not a - b and not b - a, (list((a - b))[:3], list((b - a))[:3])
    assert ours
