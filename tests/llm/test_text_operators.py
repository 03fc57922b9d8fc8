"""Operators on single texts against plain Python or the libraries themselves."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemill.llm import bpe_codec, chat, html_text, token_count, token_file, vocab
from tidemill.session import shared_path

ODD = [
    None, "", " ", "a", "a  b", " a", "a ", "a\n \nb", "\n b\n\n c ", "x.. y", "&&, a", "\0 \0a b", "3.14, 5", ", a", "A\n",
    "foo<|endoftext|> bar  <|endoftext|>", "'s don't 've", "x\x85 y  z", "q \x1c r", "日本 語 テスト", "a" * 30_000,
    "word, another. " * 3_000, "x" * 20 + "1" * 20 + "!" * 20, "🙂 é́ ​",
]
SCHEMA = "doc_id long, text string, n_tokens string, ids string, size string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, "x", "y", "z") for i, t in enumerate([*ODD, "a  b"])]
    return spark.createDataFrame(rows, SCHEMA)


def library_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_codec_round_trip(docs):
    rows = {r.doc_id: r for r in bpe_codec.decode(bpe_codec.encode(docs)).collect()}
    library = bpe_codec.codec()
    assert len(rows) == len(ODD) + 1
    for i, text in enumerate(ODD):
        row = rows[i if i != 3 else None]
        assert row.ids == library.encode_ordinary(text or "") and row.n_tokens == len(row.ids)
        assert bytes(row.decoded) == (text or "").encode()


def test_codec_splits_long_texts_where_no_token_crosses():
    text = "".join(t or "" for t in ODD)
    assert "".join(vocab.safe_pieces(text, 7)) == text
    assert bpe_codec.encode_text(text, limit=7) == bpe_codec.encode_text(text, limit=10**9)


def test_token_counts_are_the_library_s(docs):
    rows = {r.doc_id: r for r in token_count.count_tokens(docs).collect()}
    for i, (text, ids) in enumerate(zip(ODD, library_ids(ODD))):
        row = rows[i if i != 3 else None]
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (len(ids), len((text or "").encode()), len(ids) > 512)


def test_merging_takes_lowest_rank_then_leftmost():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("x", "x"): 3}
    assert token_count.merged_count(list("abc"), ranks) == 1
    assert token_count.merged_count(list("xxx"), ranks) == 2
    assert token_count.merged_count([], ranks) == 0


def test_packed_columns_unpack(spark):
    values = [[], [0], [5, 0, 1 << 59, (1 << 62) + 3], list(range(500)), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<long>")
    for row in df.select("i", token_file.packed(F.col("v")).alias("p")).collect():
        if values[row.i] is None:
            assert row.p.words is None
        else:
            got = token_file.unpack(np.frombuffer(row.p.words, "<u8"), np.frombuffer(row.p.escapes, "<u8"))
            assert got.tolist() == values[row.i]


def test_token_file(spark, docs):
    path = shared_path(spark, "tokens-test")
    token_file.write_tokens(docs, path)
    found = sorted(token_file.read_tokens(spark, path).collect(), key=lambda r: r.start)
    known = sorted((r for r in found if r.doc_id is not None), key=lambda r: r.doc_id)
    assert found[0].doc_id is None and [r for r in found[1:]] == known
    ids = dict(zip(range(len(ODD) + 1), library_ids([*ODD, "a  b"])))
    start = 0
    for row in found:
        want = [*ids[3 if row.doc_id is None else row.doc_id], 0]
        assert (row.start, row.n_tokens, row.ids) == (start, len(want), want)
        start += len(want)
    digests = {r.doc_id: r.ids_crc32 for r in token_file.read_tokens(spark, path, as_digest=True).collect()}
    assert digests[5] == zlib.crc32(np.array([*ids[5], 0], "<u4").tobytes())
    totals = spark.read.parquet(path).agg({"n_ids": "sum"}).first()[0]
    assert totals == start


@pytest.mark.parametrize("top", [0, 1, 2, 15, 1 << 16, 1 << 33, 1 << 59, (1 << 64) - 1])
def test_simple8b_round_trip(top):
    random = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 59, 240, 241, 5000):
        values = random.integers(0, top, n, dtype=np.uint64, endpoint=True)
        values[random.random(n) < 0.5] = 0
        words, escapes = token_file.pack(values)
        assert np.array_equal(token_file.unpack(words, escapes), values)
    assert len(token_file.pack(np.zeros(240, np.uint64))[0]) == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert bpe_codec.decode(bpe_codec.encode(none)).count() == 0
    assert token_count.count_tokens(none).count() == 0
    path = shared_path(spark, "tokens-none")
    token_file.write_tokens(none, path)
    assert token_file.read_tokens(spark, path).count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0
    assert chat.digests(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_chat_digests_read_back_from_segments(spark):
    nasty = ["", None, "</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "<⁠|end|>", "[⁠n<<SYS>>", "a\nb", "<|im_start|><|image|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x") for i, t in enumerate(nasty)]
    rows += [(1, 3, "assistant", "same turn", "x"), (2, 0, "tool\nx", "t", "y"), (2, 0, "tool\nx", "t", "y"), (None, None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string")
    segments = chat.format_turns(turns)
    back = chat.parse_segments(segments).collect()
    assert sorted((r.role, r.text) for r in back) == sorted((r[2] or "", r[3] or "") for r in rows)
    for row in segments.collect():  # nothing in a text can be taken for a mark
        inner = row.segment[len(chat.BEGIN) : -len(chat.END) - 1]
        assert not any(c in inner for c in chat.CONTROLS)
    found = {r.conv_id: r for r in chat.digests(segments).collect()}
    assert found[2].n_turns == 2 and found[None].n_turns == 1
    assert found[2].turns_sha256 == hashlib.sha256(b"tool\nx\nt\n" * 2).hexdigest()
    assert found[1].n_turns == len(nasty) + 1
    assert found[1].loss_chars == sum(len(t or "") for t in nasty[1::2]) + len("same turn")
    assert found[1].formatted_chars == sum(len(r.segment) for r in segments.where("conv_id = 1").collect())


def test_chat_parts(spark):
    parts = [
        ("text", "see <|image|> ", None, None, None, None, None),
        ("image", None, "a.png", 1024, 513, None, None),
        None,
        ("audio", None, "b.wav", None, None, 2.5, None),
        ("document", "ignored", "c.pdf", None, None, None, None),
        ("other", "kept", None, None, None, None, None),
    ]
    turns = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    first, second = chat.format_turns(turns, parts_col="parts").orderBy("turn").collect()
    content = first.segment[first.loss_from : first.loss_to]
    assert content == "see <⁠|image|> <|image|><|audio|><|document|>kept"
    assert [tuple(a) for a in first.attachments] == [("image", "a.png", 4 * 256), ("audio", "b.wav", 75), ("document", "c.pdf", 400)]
    assert second.attachments == [] and second.loss_from == second.loss_to


PAGES = [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>", "* x\n* y\n  * z"), ("<ol start=3><li>x</li><li>y</ol>", "3. x\n4. y"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><tr><th colspan=2>wide head</th></tr><tr><td>a</td><td>b</td></tr></table>", "wide head\na  b"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<div hidden>no</div><div style='display: none'>no</div>yes", "yes"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "yes"),
    ("<style>.x{display:none} p.y{color:red}</style><p class='a x'>no</p><p class=y>yes", "yes"),
    ("<head><title>t</title></head><body>b<script>var a='</p>';</script><!-- c --></body>", "b"),
    ("<pre>a\n  b</pre>", "a\n  b"), ("x &amp; y&nbsp;z &#x41;", "x & y z A"), ("<b>a<i>b</b>c</i> < d", "abc < d"),
    ("</p></div></br>x</table>", "x"), ("<p>a <b> b </b> c</p>", "a b c"), ("<script>never closed", ""), ("<a href='x>y'>l</a>", "l"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_html(page, text):
    assert html_text.render(page) == text


def test_html_deep_and_long():
    assert html_text.render("<div>" * 20_000 + "x") == "x"
    assert html_text.render("<p>word " * 20_000).count("word") == 20_000
    assert html_text.render("<b" * 50_000) is not None


@pytest.mark.parametrize(
    "page, text",
    [
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"),
        ("<math><semantics><mi>y</mi><annotation>why</annotation></semantics></math>", "y"),
        ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs>stray<text>seen <tspan>too</tspan></text></svg>", "seen too"),
        ("<svg style='visibility:hidden'><text>no</text></svg>x", "x"),
        ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"),
        ("<select><option>a<option selected>b</select>c", "a\nb\nc"),
        ("<object data=x><p>fallback</p></object>", "fallback"),
        ("<details><summary>more</summary><p>no</p></details>", "more"),
        ("<details open><summary>more</summary><p>yes</p></details>", "more\n\nyes"),
        ("<style media=print>p{display:none}</style><p>on screen", "on screen"),
        ("<style media='screen, print'>p{display:none}</style><p>no", ""),
        ("<style>p{display:none !important}</style><p style='display:block'>no", ""),
        ("<style>p{display:none}</style><p style='display:block'>yes", "yes"),
        ("<style>p{display:none !important}</style><p style='display:block !important'>yes", "yes"),
        ("<style>#a{display:none} .b{display:block}</style><p id=a class=b>no", ""),
        ("<style>.b{display:none} p{display:block}</style><p class=b>no", ""),
        ("<style>.b{display:none} .b{display:block}</style><p class=b>yes", "yes"),
        ("<style>.a.b{display:none} .b{display:block}</style><p class='a b'>no</p><p class=b>yes", "yes"),
        ("<style>/* p{display:none} */ @media x { q{} p{display:none} } @import 'x'; i{display:none}</style><p>yes <i>no</i>", "yes"),
        ("<style>p{display:none", ""),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<table><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>", "wide one  z\na  b      c"),
    ],
)
def test_html_cascade_and_elements(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<style>" + "lorem ipsum dolor " * 40_000,
        "<style>" + "a{" * 200_000,
        "<style>" + "/*" * 200_000,
        "<style>" + "}" * 200_000 + "display",
        "<style>" + "".join(f".c{i}{{display:none}}" for i in range(20_000)) + "</style>" + "".join(f"<p class=c{i}>x" for i in range(20_000)),
        "<table>" + ("<tr>" + "<td colspan=1000 rowspan=1000>a" * 10) * 100 + "</table>",
        "<table>" + ("<tr>" + "<td rowspan=1000>a" * 30) * 700 + "</table>",
        "<table>" + "<tr><td>a<td>" + "<br>b" * 30_000 + "<td>c" * 3_000 + "</table>",
        "<table><tr>" + "<td colspan=2>ab" * 20_000 + "</table>",
        "<svg>" * 5_000 + "<text>x",
    ],
)
def test_html_of_hostile_pages_is_quick(page):
    import time

    start = time.process_time()
    html_text.render(page)
    assert time.process_time() - start < 5


def test_table_spans_take_the_places_a_plain_walk_finds():
    import random

    r = random.Random(6)
    for _ in range(300):
        rows = [[(r.randint(1, 4), r.randint(1, 4)) for _ in range(r.randint(0, 5))] for _ in range(r.randint(1, 7))]
        taken, busy = set(), html_text._Busy()
        for i, row in enumerate(rows):
            at = plain = 0
            for across, down in row:
                while (i, plain) in taken:
                    plain += 1
                at = busy.free_from(at, i)
                assert at == plain
                down = min(down, len(rows) - i)
                taken |= {(i + k, at + c) for k in range(1, down) for c in range(across)}
                if down > 1:
                    busy.take(at, at + across, i + down, i)
                at += across
                plain += across


@pytest.mark.parametrize("width", [1, 50, 3_990, 3_994, 3_999, 4_000, 4_001, 60_000])
def test_columns_are_aligned_in_tables_of_any_width(width):
    wide = "x" * width
    page = f"<table><tr><td>{wide}<td>b<td>c<tr><td>a<td>d<td>e<tr><td><td>f<td>g</table>"
    assert html_text.render(page) == f"{wide}  b  c\n{'a'.ljust(width)}  d  e\n{' ' * width}  f  g"
    assert html_text.render(f"<table><tr><td>{page}<td>b</table>") == f"{wide}  b  c  b\n{'a'.ljust(width)}  d  e\n{' ' * width}  f  g"


def test_cells_over_columns_without_text_stand_apart():
    assert html_text.render("<table><tr><td colspan=3>abcd<td>z<tr><td>e<td><td><td>f</table>") == "abcd  z\ne     f"
    assert html_text.render("<table><tr>" + "<td colspan=1000>ab" * 3_000 + "</table>") == "  ".join(["ab"] * 3_000)


@pytest.mark.parametrize("longest", [3, 5_000])
def test_cells_of_a_column_start_at_one_place(longest):
    import random
    import re

    r = random.Random(longest)
    for _ in range(200):
        table, grid, taken = html_text.Table(), [], set()
        n_rows = r.randint(1, 7)
        for i in range(n_rows):
            at, cells, row = 0, [], []
            for _ in range(r.randint(0, 5)):
                across, down, text = r.randint(1, 4), r.randint(1, 4), "x" * r.choice((0, 1, r.randint(1, longest)))
                while (i, at) in taken:
                    at += 1
                taken |= {(i + k, at + c) for k in range(1, down) for c in range(across)}
                row.append((across, down, [text]))
                cells.append((at, text))
                at += across
            table.rows.append(row)
            grid.append(cells)
        places = {}
        for cells, line in zip([cells for cells in grid if cells], table.layout(), strict=True):
            found = [(m.start(), m[0]) for m in re.finditer(r"\S+", line)]
            assert [text for _, text in found] == [text for _, text in cells if text] and " " not in re.sub("  +", "", line)
            for (at, _), (place, _) in zip([c for c in cells if c[1]], found, strict=True):
                assert places.setdefault(at, place) == place
        assert sorted(places, key=lambda at: (places[at], at)) == sorted(places)


def test_html_of_padded_tables_is_handed_on_in_pieces(spark):
    page = "<table><tr><td>" + "x" * 20_000 + "<td>b" + "<tr><td>a<td>b" * 250
    rows = spark.createDataFrame([(i, page if i % 2 else "<p>a<p>b") for i in range(6)], "page_id long, html string").coalesce(1)
    found = {r.page_id: (r.n_chars, r.n_lines) for r in html_text.extract_text(rows).select("page_id", "n_chars", "n_lines").collect()}
    assert found == {i: (251 * 20_003 + 250, 251) if i % 2 else (4, 3) for i in range(6)}


def test_html_query_columns(spark):
    rows = spark.createDataFrame([(1, "<p>a", "clash"), (1, "<p>a", "clash"), (None, None, None)], "page_id long, html string, text string")
    assert sorted(map(tuple, html_text.extract_text(rows).collect()), key=repr) == [(1, "a", 1, 1), (1, "a", 1, 1), (None, "", 0, 0)]
