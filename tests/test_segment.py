import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlink.operators import segment

# Texts and the sentences' spans that they must have.
CASES = [
    ("A b. C d!  E\n\nF g? ", [(0, 4), (5, 9), (11, 12), (14, 18)]),
    ("\n\nLead. é x. Y z", [(0, 0), (2, 7), (8, 12), (13, 16)]),
    ("", []),
    ("no end", [(0, 6)]),
    ("😀 a. b", [(0, 4), (5, 6)]),
    (None, []),
    ("   ", [(0, 3)]),
]


def test_sentences(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {}
    for r in segment.sentences(docs).orderBy("doc_id", "sent_idx").collect():
        got.setdefault(r.doc_id, []).append((r.s_start, r.s_end))
        assert CASES[r.doc_id][0][r.s_start : r.s_end] == r.s_text
    assert got == {i: s for i, (_, s) in enumerate(CASES) if s}


def test_contiguous_segments_and_chunks_cover_texts(spark):
    texts = ["One. Two!  Three? \n\nFour", "  lead. x", "a. " * 900, "word " * 500 + ". end", "\n\n", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows, most in ((segment.contiguous(docs), None), (segment.chunks(docs, 100), 100)):
        got = {}
        for r in rows.collect():
            got.setdefault(r[0], []).append((r[1], r[2], r[3], r[4]))
        for i, parts in got.items():
            parts.sort()
            assert "".join(p[3] for p in parts).strip() == texts[i].strip()
            assert [p[0] for p in parts] == list(range(len(parts)))
            assert all(a[2] == b[1] for a, b in zip(parts, parts[1:], strict=False))
            if most:
                assert all(a[2] - a[1] + b[2] - b[1] > most for a, b in zip(parts, parts[1:], strict=False))
        assert 4 not in got and 5 not in got


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=400))
def test_overlap_bounds(text):
    bounds = list(segment.overlap_bounds(text, 50, 10))
    assert ([] if not text else [0]) == [b[0] for b in bounds[:1]]
    for (a, b), (c, d) in zip(bounds, bounds[1:], strict=False):
        assert c == b - 10 and d > b and 25 < b - a <= 52
    if text:
        assert bounds[-1][1] == len(text)


def test_overlap_must_fit():
    with pytest.raises(ValueError):
        segment.overlap_chunks(None, 300, 200)
