import random
import re
import zlib

from ledgerlens.llm import passages
from tests.llm.helpers import PROSE, ROWS, SF, no_rows, odd_rows


def plain_units(text):
    """The unit rule once more, character by character."""
    out, own, i = [], [], 0

    def close():
        if own:
            a, b, words = own[0][0], own[-1][1], len(own)
            out.append((a, b, " ".join(text[a:b].lower().strip(passages.EDGES).split()), words))
            own.clear()

    def spaceless(c):
        return any(lo <= c <= hi for lo, hi in (("\u2e80", "\u9fff"), ("\uac00", "\ud7af"), ("\uf900", "\ufaff"), ("\uff66", "\uff9f")))

    # Places behind which a sentence ends.
    ends = set()
    for m in re.finditer(r"[.!?…]+[\"'”’)\]]*(?=\s)|[。！？]+[\"'”’」』）)\]]*", text):
        ends.add(m.end())
    while i < len(text):
        if text[i] == "\n":
            close()
            i += 1
        elif text[i].isspace():
            i += 1
        else:
            j = i + 1
            if not spaceless(text[i]):
                while j < len(text) and not text[j].isspace() and not spaceless(text[j]) and j not in ends:
                    j += 1
            own.append((i, j))
            if zlib.crc32(text[i:j].lower().encode()) % passages.CUT_EVERY == 0:
                close()
            i = j
        if i in ends:
            close()
    close()
    return out


def plain(rows, least=passages.LEAST_WORDS):
    """Every unit met before, in the order of documents and places, where enough of them adjoin."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        runs = [[]]
        for a, b, unit, words in plain_units(text or ""):
            if unit in seen:
                runs[-1].append((a, b, words))
            else:
                runs.append([])
            seen.add(unit)
        spans = [f"{a}:{b}" for run in runs if sum(w for *_, w in run) >= least for a, b, _ in run]
        if spans:
            out[i] = ",".join(spans)
    return out


def test_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.removed for r in passages.dedup_units(docs).collect()}
    assert len(got) == len(rows)
    assert {i: s for i, s in got.items() if s} == plain(rows)


def test_units():
    text = "  A first line of just six words. And one (more) of six words!\nshort line\nÄ line with no mark at its end"
    got = [(text[a:b], n, w) for a, b, n, w in passages.units(text)]
    assert [g[0] for g in got] == ["A first line of just six words.", "And one (more) of six words!", "short line", "Ä line with no mark at its end"]
    assert got[0][1:] == ("a first line of just six words", 7)
    for text in (text, "", " \n ", "これは文です。次の文！「引用。」終わり", "한국어 문장. 또 하나", "a.b. c", "x。 y", "mixed 漢字 and words. " * 40):
        assert list(passages.units(text)) == plain_units(text)


def test_passages_of_all_kinds_are_found_and_chance_is_not(spark):
    """Short sentences, lines without spaces, and a passage inside a line without marks; one short sentence alone stays."""
    rng = random.Random(4)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))

    short = " ".join(f"{words(4).capitalize()}." for _ in range(14))
    spaceless = "".join(chr(rng.randint(0x4e00, 0x9000)) for _ in range(60))
    running = words(120)
    rows = []
    for k, passage in enumerate((short, spaceless, running, "Just a short one.")):
        rows += [(10 * k + j, f"{words(30)}{"." if k == 3 else ""} {passage} {words(30)}") for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.removed_chars for r in passages.dedup_units(df).collect()}
    assert {i: s for i, s in plain(rows).items()} == {r.doc_id: r.removed for r in passages.dedup_units(df).collect() if r.removed}
    for k, passage in enumerate((short, spaceless, running)):
        assert got[10 * k] == 0 and min(got[10 * k + 1], got[10 * k + 2]) > (0.9, 0.5, 0.5)[k] * len(passage)
    assert got[30] == got[31] == got[32] == 0
    every = {r.doc_id: r.n_removed for r in passages.dedup_units(df, least_words=1).collect()}
    assert every[31] and every[32]


def test_a_passage_inside_other_text_is_found(spark):
    passage = "Some words begin it. Here is the inner sentence of the passage that repeats. Another full sentence of it stands right here. It ends"
    rows = [(1, f"Start of one {passage} tail one"), (2, f"quite another start {passage} other tail"), (3, "A clean text that shares nothing with the other two.")]
    got = {r.doc_id: r for r in passages.dedup_units(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].n_removed == got[3].n_removed == 0 and got[2].n_removed >= 2
    cut = {r.doc_id: r.text for r in passages.remove_units(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert cut[1] == rows[0][1] and "inner sentence" not in cut[2] and cut[2].endswith("It ends other tail")


def test_rows_without_an_id_and_rows_of_one_id(spark):
    unit, other = "This unit of words comes twice.", "Another unit of words comes here."
    rows = [(None, unit), (None, f"Short. {unit}"), (None, f"{other} {unit}"), (1, other), (2, f"{other} Tail."), (2, f"Head. {other}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    texts = sorted(r.text for r in passages.remove_units(df, least_words=1).filter("doc_id is null").collect())
    assert sum(unit in t for t in texts) == 1 and not any(other in t for t in texts)
    assert [t for t in texts if unit not in t] in ([" ", "Short. "], ["", " "], ["", "Short. "])
    got = sorted((r.doc_id, r.removed) for r in passages.dedup_units(df, least_words=1).filter("doc_id = 2").collect())
    assert got == [(2, f"0:{len(other)}"), (2, f"6:{6 + len(other)}")]


def test_odd_rows(spark):
    out = passages.dedup_units(odd_rows(spark)).collect()
    assert len(out) == len(ROWS)
    by_id = {r.doc_id: r for r in out}
    assert by_id[1].n_removed == 0 and by_id[2].removed == f"0:{len(PROSE)}" and by_id[4].removed == ""
    assert {r.removed for r in out if r.doc_id == 3} == {""}  # one document, however often its row comes
    assert passages.dedup_units(no_rows(spark)).count() == 0
    assert passages.remove_units(odd_rows(spark)).columns == odd_rows(spark).columns
