import numpy as np
import pytest

from ledgerlens.llm import neardup
from ledgerlens.llm.components import connected
from tests.llm.helpers import PROSE, ROWS, SF, components, no_rows, odd_rows


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, width, percent):
    """The given documents, and a group of copies that drift apart so that some are linked only through others."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(200)]
    for k in range(120):
        if k % 3 == 0:
            own = list(words)
        own[int(rng.integers(200))] = f"new{k}"
        if k % 5 == 0:
            own = [f"far{k}x{i}" if rng.random() < 0.06 else w for i, w in enumerate(own)]
        docs.append((100_000 + k, " ".join(own)))
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), width, percent).collect()
    assert {r.doc_id: r.component_id for r in rows} == components(dict(docs), width, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_odd_rows(spark):
    out = neardup.near_duplicates(odd_rows(spark)).collect()
    assert len(out) == len(ROWS)
    own = {r.doc_id: r for r in out}
    assert own[1].component_id == own[2].component_id == own[3].component_id == 1
    assert [own[i].n_shingles for i in (4, 5, 6)] == [0, 0, 0] and all(own[i].kept for i in (4, 5, 6))
    assert own[9].component_id == 8 and own[8].kept and not own[9].kept
    assert sorted((r.n_shingles > 0, r.component_id, r.kept) for r in out if r.doc_id is None and r.n_shingles) == [(True, 1, False)]
    assert neardup.near_duplicates(no_rows(spark)).count() == 0


def test_rows_without_an_id_and_repeated_rows(spark):
    """Near copies without ids, equal rows of one id, against all pairs of rows."""
    words = [f"w{i}" for i in range(200)]

    def text(k):
        return " ".join(f"new{k}" if i == 7 * k else w for i, w in enumerate(words)) if k else " ".join(words)

    rows = [(None, text(1)), (None, text(1)), (None, text(2)), (7, text(0)), (7, text(0)), (None, "quite another text of some nine words in all"),
            (None, "quite another text of some nine words in all"), (9, None), (9, None), (3, "a text of its own that stands alone here"), (3, "a second text of that id with other words")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, row_key int").repartition(4)
    plain = components({k: t for k, (_, t) in enumerate(rows)}, 3, 85)
    group = {}
    for k, root in plain.items():
        group.setdefault(root, []).append(rows[k][0])
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in group.items()}
    got = neardup.near_duplicates(df, 3, 85).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(((rows[k][0], least[root]) for k, root in plain.items()), key=str)
    assert sum(r.stays for r in got) == len(group) and all(r.kept for r in got if r.stays)
    stay = neardup.one_of_each(df, 3, 85)
    assert stay.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in stay.collect()), key=str) == sorted(
        [(7, text(0)), (None, rows[5][1]), (9, None), (9, None), (3, rows[9][1]), (3, rows[10][1])], key=str)


def test_exact_search_alone(spark, monkeypatch):
    """Without any round, and with buckets that only stand-ins opened, the search still joins all that belongs together."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(150)]
    docs = []
    for k in range(250):
        own = [f"x{k}_{i}" if rng.random() < 0.035 else w for i, w in enumerate(words)]
        docs.append((k, " ".join(own)))
    want = components(dict(docs), 3, 85)
    assert 3 < len(set(want.values())) < 200
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for rounds, first in ((0, 1), (2, 3)):
        monkeypatch.setattr(neardup, "ROUNDS", rounds)
        monkeypatch.setattr(neardup, "FIRST", first)
        assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 3, 85).collect()} == want


def test_exact_search_finds_what_pivots_leave(spark):
    """All pairs of different components at the threshold, from the prefix filter alone."""
    texts = {i: PROSE.replace("grey", f"g{i // 2}").replace("noon", f"n{i}") for i in range(12)}
    sets = [(i, len(s), [int(x) for x in s.view(np.int64)]) for i, s in ((i, neardup.shingles(t.encode(), 3)) for i, t in texts.items())]
    frame = spark.createDataFrame(sets, neardup.SETS)
    groups = spark.createDataFrame([(i, i) for i in texts], "id bigint, component bigint")
    got = {tuple(r) for r in neardup.confirmed(neardup.ordered_pairs(neardup.across(frame, groups, 85)), frame, 85).collect()}
    full = {i: set(s[2]) for i, s in enumerate(sets)}
    assert got == {(a, b) for a in full for b in full if a < b and 100 * len(full[a] & full[b]) >= 85 * len(full[a] | full[b])}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, i) for i in range(1001, 1050)] + [(5, 5)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1050)}
