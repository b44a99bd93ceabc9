"""Fill-in-the-middle against plain slicing; small frames, long runs, marks, odd rows."""

import hashlib
import re

import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from delaylens.llm import fill_in_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def by_hand(key, text):
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digits[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("frame", [4, 7, 1 << 16])
def test_odd_rows(spark, frame):
    texts = [None, "", "plain words, and more of them", "é\U0001f600の x", "a" * 300, "<P> is a mark", "<", "<<PS>M><", "  \n\n",
             "ab1cd2" * 40, "same", "same"]
    rows = [(i + 100 * r, t, "kept", 5) for r in range(12) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, "no key at all", "kept", 5)], "doc_id long, text string, h0 string, fm_units long")
    made = fim.arranged(fim.stored(docs, frame=frame), frame=frame)
    assert made.columns == ["doc_id", "text", "h0", "fm_units", "fm_form", "fm_prefix_chars", "fm_middle_chars", "fm_output"]
    forms = set()
    for r in fim.texts(made).collect():
        want = by_hand("" if r.doc_id is None else r.doc_id, r.text or "")
        assert (r.fm_units, r.fm_form, r.fm_prefix_chars, r.fm_middle_chars, r.fm_text) == want
        forms.add(r.fm_form)
    assert forms == {"plain", "psm", "spm"}
    for r in fim.digested(made).collect():
        want = by_hand("" if r.doc_id is None else r.doc_id, r.text or "")
        assert r.fm_output_sha256 == hashlib.sha256(want[-1].encode()).hexdigest()
        assert r.fm_restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert fim.digested(fim.arranged(fim.stored(docs.limit(0)))).isEmpty()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<>PSM é\U0001f600\n", max_size=60), st.integers(0, 100), st.integers(0, 100), st.integers(4, 20),
       st.sampled_from(["psm", "spm"]))
def test_cuts_frames_and_rebuilding(text, one, two, frame, form):
    packer, opener = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    frames = fim.frames_of(text.encode(), frame, packer)
    assert all(len(opener.decompress(f["data"])) <= frame for f in frames)
    units = UNIT.findall(text)
    seek = fim.Seekable(frames, opener)
    assert (seek.ends[-1] if frames else 0) == len(units)
    a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
    cuts = [seek.cut(u) for u in (a, b)]
    assert [c[2] for c in cuts] == [len("".join(units[:u])) for u in (a, b)]
    marked = any(m in text for m in ("<P>", "<S>", "<M>"))
    assert seek.holds((fim.PREFIX, fim.SUFFIX, fim.MIDDLE)) == marked
    if not marked:
        out = list(fim.output_frames(seek, form, [c[:2] for c in cuts], frame, packer))
        pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, len(units))))
        want = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
        assert b"".join(map(opener.decompress, out)).decode() == want
        assert b"".join(fim.rebuilt(out, form, opener)).decode() == text


def test_only_cut_frames_are_opened():
    class Counting:
        def __init__(self):
            self.inner, self.n = zstandard.ZstdDecompressor(), 0

        def decompress(self, data):
            self.n += 1
            return self.inner.decompress(data)

    text = ("one two three 4 " * 5000).encode()
    packer, opener = zstandard.ZstdCompressor(), Counting()
    seek = fim.Seekable(fim.frames_of(text, 1000, packer), opener)
    assert len(seek.frames) == 80
    cuts = [seek.cut(u)[:2] for u in (1000, 20_000)]
    list(fim.output_frames(seek, "psm", cuts, 1000, packer))
    assert opener.n <= 6
