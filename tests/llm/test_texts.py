"""Operators on texts, on rows with nulls, empty and long texts, repeats and odd columns."""

import base64
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from newsloom.llm import bpe, chat_format, compression, decontamination, personal_data, token_files, wrappers
from newsloom.llm.chunks import cut, spelled
from newsloom.session import scratch_path

PHRASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
ROWS = [
    (1, "Write to a.b@c.org or +49 30 1234567, host 10.0.0.255, card 4111 1111 1111 1111."),
    (2, None),
    (3, ""),
    (4, "  \n\t "),
    (5, "word " * 30_000 + "x" * 50_000),
    (6, f"Before {PHRASE.upper()} after"),
    (6, f"Before {PHRASE.upper()} after"),
    (None, f"{PHRASE} token = \"{'0a1b2c3d' * 5}\""),
    (-8, "naïve 日本語 \x1c\x85 <|endoftext|>  🙂\r\n\n z"),
]
SCHEMA = "doc_id long, text string, score double, high int, region string, `odd name` int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1.0, 2, "r", 3) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def some(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows.collect()), key=repr)


def tiktoken_encoding():
    import tiktoken

    lines = open(P.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_cuts_keep_the_text():
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice(" \n\t\xa0ab.é") for _ in range(draw.randint(0, 20)))
        first, rest = cut(text)
        assert first + "".join(map(spelled, rest)) == text


def test_bpe_is_the_library(docs, none):
    path, encoding = P.path("byte_bpe_50k.tiktoken"), tiktoken_encoding()
    expected = []
    for i, t in ROWS:
        ids = encoding.encode_ordinary(t or "")
        raw = (t or "").encode()
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()))
    found = bpe.round_trip(docs, path, P.PATTERN)
    assert some(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert bpe.round_trip(none, path, P.PATTERN).collect() == []
    encoder, draw = bpe.Bpe(path, P.PATTERN), random.Random(6)
    for _ in range(3000):
        text = "".join(draw.choice(" \n\t\x1c abcde'sré中0³²!?🙂") for _ in range(draw.randint(0, 30)))
        assert encoder.encode(text) == encoding.encode_ordinary(text)


def test_bpe_round_trip_takes_one_python_process_a_task(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(1, "One two, two\n three."), (2, None)], "doc_id long, text string")
    found = bpe.round_trip(docs, path, P.PATTERN)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    encoder = bpe.Bpe(path, P.PATTERN)
    ids = encoder.encode("One two, two\n three.")
    assert {r.doc_id: bytes(r.ids) for r in found.collect()} == {1: b"".join(i.to_bytes(4, "little") for i in ids), 2: b""}


class Drawn:
    """An automaton that counts the matches it gives."""

    def __init__(self, automaton):
        self.automaton, self.n = automaton, 0

    def _counted(self, matches):
        for match in matches:
            self.n += 1
            yield match

    def iter(self, *a):
        return self._counted(self.automaton.iter(*a))

    def iter_long(self, *a):
        return self._counted(self.automaton.iter_long(*a))


def test_bpe_draws_the_longest_matches_only():
    encoder, draw = bpe.Bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), random.Random(8)
    encoding, drawn, n_ids = tiktoken_encoding(), Drawn(encoder.automaton), 0
    encoder.automaton = drawn
    entries = sorted(encoder.ranks)
    for _ in range(2000):
        piece = "".join(draw.choices(entries, k=draw.randint(1, 5)))[draw.randint(0, 3) :].encode("latin-1") or b"x"
        ids = encoder.encode_piece(piece)
        assert ids == encoding._core_bpe.encode_single_piece(piece)
        n_ids += len(ids)
    assert drawn.n < 2 * n_ids


def test_uneven_white_space():
    import itertools

    from newsloom.llm import chunks

    for n in range(5):
        for text in map("".join, itertools.product("a \n\t\x0b\r\x85\xa0\u3000\x1c", repeat=n)):
            assert chunks.uneven(text) == (chunks.UNEVEN.search(text) is not None)


def test_words_are_remembered_once():
    encoder = token_files.Encoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    encoder.encode("Some words, some more wörds.")
    assert {"words", "more", "wörds"} <= {*encoder.parts}
    assert not any(piece.strip().isalpha() for piece in encoder.pieces if piece != "Some")


def test_elias_fano():
    draw = random.Random(7)
    for n in (0, 1, 2, 300, 1000):
        for step in (0, 1, 3, 5000):
            values = np.cumsum([draw.randint(0, step) for _ in range(n)]) if n else np.zeros(0, dtype=int)
            data = token_files.EliasFano.of(values).to_bytes()
            found, end = token_files.EliasFano.read(b"xx" + data, 2)
            assert end == len(data) + 2
            assert found.all().tolist() == list(values)
            assert [found.select(i) for i in range(n)] == list(values)


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, P.path("byte_bpe_50k.json"), P.PATTERN, 2, path)
    start, expected = 0, []
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_files.read_tokens(spark, path)
    assert some(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(none, P.path("byte_bpe_50k.json"), P.PATTERN, 2, path)
    assert token_files.read_tokens(spark, path).collect() == []


def test_decontamination(spark, docs, none, monkeypatch):
    near = PHRASE.split()
    near[0], near[1] = near[1], near[0]
    items = [(1, PHRASE), (2, None), (3, ""), (None, "naïve 日本語"), (4, " ".join(near[:13]))]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    for block in (decontamination.BLOCK_CHARS, 40):
        monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
        found = decontamination.contamination(docs, benchmark)
        got = {(r.doc_id, r.n_words): r for r in found.collect()}
        assert len(got) == len(ROWS) - 1  # one row is there twice
        six = got[6, 17]
        assert (six.n_hit, six.item_ids, six.contaminated) == (15, ["1"], True)
        assert six.hits == [[1, 16]] and "4" in six.near_item_ids
        assert got[-8, 6].item_ids == ["None"] and got[-8, 6].n_hit == 2
        assert got[2, 0].contaminated is False
        assert found.count() == len(ROWS)
    assert decontamination.contamination(none, benchmark).collect() == []
    assert {r.n_hit for r in decontamination.contamination(docs, benchmark.limit(0)).collect()} == {0}


def luhn(s):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(s[::-1])) % 10 == 0


def plain_spans(text):
    found = []
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            ):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_personal_data(docs, none):
    draw = random.Random(8)
    parts = ["1", "23", "4", ".", "@", "a", "b.c", "-", " ", "+", "(", "256", "x@y.z", "4111 1111 1111 1111", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert personal_data.base_spans(text) == plain_spans(text)
    found = {r.doc_id: r for r in personal_data.find(docs).collect()}
    assert [found[1][f"n_{k}"] for k in personal_data.BASE] == [1, 1, 1, 1]
    assert "secret:" in found[None].spans
    assert found[2].spans == found[3].spans == "" and found[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert personal_data.find(none).collect() == []
    clean = personal_data.redacted(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[1] == "Write to [EMAIL] or [PHONE], host [IP], card [CARD]." and texts[2] is None


def test_votes_give_reliabilities():
    draw = np.random.default_rng(9)
    truth = draw.random(4000) < 0.4
    right = [0.95, 0.9, 0.8, 0.55]
    votes = np.stack([np.where(draw.random(4000) < p, truth, ~truth) * 2 - 1 for p in right], axis=1)
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    likely, tables = personal_data.reliabilities(rows, np.zeros(len(rows), int), counts.astype(float))
    place = {tuple(r): p for r, p in zip(rows.tolist(), likely)}
    assert np.mean([(place[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth)]) > 0.93
    assert np.all(np.diff(tables[:, 2, 1]) < 0.02)


def test_chat(spark):
    text = "\\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", text), (1, 0, "user", text), (1, 0, "user", text), (2, None, None, None), (None, 3, "a:#", "</ \\")]
    rows += [(3, t, "assistant" if t % 2 else "user", f" {t} </turn>\n") for t in range(40)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, place int")
    pieces = chat_format.formatted(turns)
    found = {r.conv_id: r for r in chat_format.read_back(pieces).collect()}
    assert set(found) == {1, 2, 3, None} and sum(r.rewritten for r in found.values()) == 0
    for conv, r in found.items():
        own = sorted((t or 0, a or "", x or "") for c, t, a, x in rows if c == conv)
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in own).encode()).hexdigest()
        loss = "".join(x for _, a, x in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(chat_format.template([(a, x) for _, a, x in own]))
    assert chat_format.read_back(chat_format.formatted(turns.limit(0))).collect() == []


def test_template_that_rewrites_history():
    def render(turns):
        return "".join(f"<{r}>{t if k == len(turns) - 1 else t.strip()}</>" for k, (r, t) in enumerate(turns))

    assert chat_format.located(render, [("a", " x "), ("b", "y")])[3] > 0
    piece, begin, end, changed = chat_format.located(render, [("a", "x"), ("b", " </>y")])
    assert (piece[begin:end], changed) == (" </>y", 0)


PAGE = (
    '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a>n</a></nav><div class="ad">buy</div>'
    "{}<footer>f</footer></body></html>"
)


def test_wrappers(spark):
    article = "<article><h1>Title &amp;&nbsp;more</h1><p>one <b>two</b>\n three<p>four<br><ul><li>x<li>y</ul></article>"
    plain = '<div id="c1"><p>long text here</p><p>and more of it</p><div class="comments"><p>bad</p></div></div>'
    rows = [
        (1, "http://a.x/1", PAGE.format(article)),
        (2, "http://a.x/2", PAGE.format("<article><p>only</article>")),
        (3, "http://b.x/1", PAGE.format(plain)),
        (4, "http://b.x/2", PAGE.format('<div id="c2"><p>short</p></div>')),
        (5, None, None),
        (6, "no url", ""),
        (None, "http://a.x/1", PAGE.format(article)),
        (8, "http://c.x", "<div>" * 3000 + "deep"),
        (9, "http://d.x", "just <i>text</i> &lt"),
    ]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, host int")
    found = {r.page_id: (r.text, r.n_chars) for r in wrappers.extract(pages).collect()}
    long = "Title & more\none two three\nfour\nx\ny"
    assert found[1] == found[None] == (long, len(long))
    assert found[2][0] == "only" and found[3][0] == "long text here\nand more of it" and found[4][0] == "short"
    assert found[5] == found[6] == ("", 0)
    assert found[8][0] == "deep" and found[9][0] == "just text <"
    assert wrappers.extract(pages.limit(0)).collect() == []


def test_wrapper_expression():
    pages = ["<ul><li>a<li>b</ul><p>x</p>", "<ul><li>a</ul><h2>t</h2><p>x</p><p>y</p>"]
    a, b = (wrappers._copy(wrappers.parsed(p)) for p in pages)
    assert wrappers.expression(wrappers.joined(a, b)) == "<ul>(<li>#</li>)+</ul>(<h2>#</h2>)?(<p>#</p>)+"


def labelled(spark):
    draw, rows, labels = random.Random(10), [], []
    words = ["mesa", "lado", "verde", "rio", "campo", "luz", "tempo", "vento", "pedra", "folha"]
    for i in range(900):
        toxic, good = int(i % 6 == 0), int(i % 5 != 0)
        text = [draw.choice(words) + draw.choice(["", "s", "mente"]) for _ in range(60)]
        if toxic:
            for _ in range(3):
                text[draw.randrange(60)] = "grosk" + draw.choice(["", "a", "oso"])
        if not good:
            text = [w + draw.choice(["###", "$$$"]) for w in text]
        rows.append((i, " ".join(text)))
        labels.append((i, good, toxic))
    rows += [(None, None), (5000, ""), (5001, " \n")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("label", ["toxic", "quality"])
def test_compression_classifiers(spark, label):
    docs, labels = labelled(spark)
    train = compression.train_toxicity if label == "toxic" else compression.train_quality
    apply = compression.toxicity if label == "toxic" else compression.quality
    found = apply(docs, train(docs, labels), ["doc_id"])
    rows = found.select("*", compression.held_out().alias("held_out")).collect()
    truth = {r.doc_id: r[label] for r in labels.where("toxic is not null").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert len(rows) == 903 and all(0 <= r.score <= 1 for r in rows)
    # Without labels of both classes every score is the prior.
    lone = apply(docs, train(docs, labels.where(f"{label} = 1")), ["doc_id"])
    assert lone.select("score").distinct().count() == 1
    assert apply(docs.limit(0), train(docs.limit(0), labels), ["doc_id"]).collect() == []


def test_marks_of_what_holds_the_article():
    def article(*pages):
        host = [wrappers._copy(wrappers.parsed(p)) for p in pages]
        whole = host[0]
        for other in host[1:]:
            whole = wrappers.joined(whole, other)
        return [wrappers.main_text(p, wrappers.text_paths(whole)) for p in pages]

    page = "<html><body{}><div{}><{}><h1>Title</h1><p>text</p><div class='box ad'>buy</div></{}></div></body></html>"
    for body, div, kind in (
        (' class="single has-sidebar"', "", "article"),
        (' class="ads"', "", "article"),
        ("", "", 'article class="post comments-open"'),
        ("", "", 'article id="social-policy"'),
        ("", "", 'article class="comments"'),
        ("", ' id="content" class="with-ads"', "article"),
        ("", ' class="ads"', "article"),
        ("", ' class="widget"', "main"),
        (' class="has-sidebar"', "", 'div id="social-policy"'),
    ):
        assert article(page.format(body, div, kind, kind.split()[0])) == ["Title\ntext"]
    # Furniture stays furniture where the article stands elsewhere.
    two = '<div class="ad-banner"><article>buy</article></div><article>text<p class="social-share">share</p></article>'
    assert article(two) == ["text"]
    assert article('<div class="related"><article>other</article></div><main>text</main>') == ["text"]
    assert article('<main><div class="widget"><article>text</article></div></main>') == ["text"]
    assert article('<form id="all"><article>text</article></form>') == ["text"]


def test_toxic_segments_anywhere(spark):
    docs, labels = labelled(spark)
    draw = random.Random(12)
    words = ["mesa", "lado", "verde", "rio", "campo", "luz", "tempo", "vento", "pedra", "folha"]
    many = ["".join(draw.choice("bcdfgjkqwxyz") + draw.choice("aeiou") for _ in range(4)) for _ in range(90)]
    more, known = [], []
    for i in range(10_000, 12_400):
        text = [draw.choice(words) for _ in range(60)]
        toxic, kind = int(i % 4 == 0), i // 4 % 3
        if toxic and kind == 0:  # one of many words
            text[9:9] = draw.sample(many, 3)
        elif toxic and kind == 1:  # words that only together say it
            text[9:11] = text[40:42] = ["rio", "luz", "rio", "mesa"]
        elif toxic:  # no blanks
            text = [*text[:20], "日月山川" + "白痴垃圾" + "水火木金", *text[20:]]
        elif kind == 1:
            text[9:9] = ["日月山川水火木金"]
        more.append((i, " ".join(text if toxic and kind == 1 else [w for k, w in enumerate(text) if text[k - 2 : k + 1] != ["rio", "luz", "rio"]]), 0.5))
        known.append((i, 1, toxic))
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    model = compression.train_toxicity(docs, labels.union(spark.createDataFrame(known, labels.schema)))
    plain = " ".join(draw.choice(words) for _ in range(60))
    odd = [f"{plain} mesa-grosk {plain} luz-groska {plain}", f"{plain} lado,vento,grosk/rio {plain} #campogrosk {plain}"]
    odd += [f"{plain} {w.upper()} {plain} x-{v} {plain} rio/{u}" for w, v, u in zip(many, many[30:], many[60:])]
    odd += ["日月山川水火木金" * 30 + "白痴垃圾" + "水火木金日月山川" * 30, f"{plain} rio luz rio mesa {plain} rio luz rio mesa"]
    clean = [plain, plain.replace(" ", "-"), "日月山川水火木金" * 60]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(odd + clean)], "doc_id long, text string")
    found = {r.doc_id: r.predicted for r in compression.toxicity(rows, model, ["doc_id"]).collect()}
    assert [found[i] for i in range(len(found))] == [1] * len(odd) + [0] * len(clean)


def test_article_in_sibling_blocks():
    def article(*pages):
        host = [wrappers._copy(wrappers.parsed(p)) for p in pages]
        whole = host[0]
        for other in host[1:]:
            whole = wrappers.joined(whole, other)
        return [wrappers.main_text(p, wrappers.text_paths(whole)) for p in pages]

    two = "<nav>n</nav><div id=content><section class=a><p>{}</p></section><section class=b><p>{}</p></section></div><footer>f</footer>"
    assert article(two.format("one " * 9, "two"), two.format("three", "four " * 9)) == [
        f"{' '.join(['one'] * 9)}\ntwo", f"three\n{' '.join(['four'] * 9)}"
    ]
    listed = f"<div id=top class=menu>m</div><div id=content><p>text</p><ul>{'<li>a longer item' * 5}</ul><p>end</p></div>"
    assert article(listed) == ["\n".join(["text", *["a longer item"] * 5, "end"])]


def test_template_that_looks_back_to_the_beginning(spark):
    def render(turns):
        first = "old" if len(turns) > 30 else "new"
        return "".join(f"<{k} {r} {first if k == 0 else ''}>{t}</>" for k, (r, t) in enumerate(turns))

    own = [("assistant" if k % 2 else "user", f"text {k}") for k in range(40)]
    turns = spark.createDataFrame([(1, k, *t) for k, t in enumerate(own)], "conv_id long, turn long, role string, text string")
    shown, rows = "", sorted(chat_format.formatted(turns, render).collect(), key=lambda r: r.place)
    for k, r in enumerate(rows):
        shown = shown[: len(shown) - r.rewritten] + r.piece
        assert shown == render(own[: k + 1]) and (r.rewritten > 0) == (k == 30)
        assert r.piece[r.begin : r.end] == own[k][1]


@pytest.mark.parametrize("declared", [None, 1])
def test_every_prefix_of_a_conversation_is_rendered(spark, tmp_path, declared):
    @functools.wraps(chat_format.template)
    def render(turns):
        with open(tmp_path / "lengths", "a") as out:
            out.write(f"{len(turns)}\n")
        return chat_format.template(turns)

    if declared is not None:
        render.reach = declared
    own = [(1, k, "assistant" if k % 2 else "user", f"# {k}") for k in range(12)]
    turns = spark.createDataFrame(own, "conv_id long, turn long, role string, text string")
    pieces = sorted(chat_format.formatted(turns, render).collect(), key=lambda r: r.place)
    assert "".join(r.piece for r in pieces) == chat_format.template([r[2:] for r in own])
    assert {int(n) for n in (tmp_path / "lengths").read_text().split()} == set(range(13))


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    from tokenizers import Tokenizer

    from newsloom.llm import queries

    rows = [(1, "a <|endoftext|> b"), (2, "x<|endoftext|><|endoftext|>y <|endoftext"), (3, "plain text"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, start, expected = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0, []
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = queries.op5_token_files(spark, str(tmp_path))
    assert some(found, "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_closing_tags_of_deep_elements():
    deep = f"<div><article>{'<div>' * 200}<p>inner</p>{'</div>' * 200}<p>rest</p></article></div><p>after</p>"
    assert wrappers.main_text(deep, [("div", "article")]) == "inner\nrest"
    items = f"<article>{'<div>' * 160}<ul><li>a<li>b</ul><p>c<p>d{'</div>' * 160}<p>rest</article>"
    assert wrappers.main_text(items, [("article",)]) == "a\nb\nc\nd\nrest"


def test_training_keeps_texts_with_the_tasks(spark, monkeypatch):
    rows = [(k, f"word{k % 7} and {'some vile slur' if k % 4 == 0 else 'an ordinary thing'} no {k}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    monkeypatch.setattr(compression, "sample", lambda *_: pytest.fail("texts in the driver"))
    model = compression.train_toxicity(docs, labels)
    assert any("vile" in segment for segment in model["typical"]) and model["fit"] is not None
    found = compression.toxicity(docs, model, ["doc_id"]).collect()
    assert {r.doc_id for r in found if r.predicted} == {k for k in range(400) if k % 4 == 0}


def test_counted_segments_are_those_asked_for():
    import numpy as np

    documents = [" abab cd ", " abab ce ", " xyab cd "]
    every = np.ones(1 << compression.COUNT_BITS, bool)
    numbers, contexts, within, _ = compression._counted(documents, 2, every)
    twice, *_ = compression._counted(documents, 2, every, 2)
    assert twice.tolist() == numbers[within >= 2].tolist()
    some = numbers[::3]
    again, counts, _, _ = compression._counted(documents, 2, every, known=some)
    assert again.tolist() == some.tolist() and counts.tolist() == contexts[::3].tolist()


def test_counting_segments_takes_bounded_memory():
    import tracemalloc

    draw = random.Random(9)
    documents = ["".join(draw.choices("abcdefghij", k=100_000)) for _ in range(24)]
    every = np.ones(1 << compression.COUNT_BITS, bool)
    tracemalloc.start()
    numbers, contexts, within, _ = compression._counted(documents, 5, every)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = {d[k : k + 5] for d in documents for k in range(len(d) - 4)}
    assert len(numbers) == len(found) and contexts.min() >= 1 and within.max() <= 24
    assert peak < 130e6
