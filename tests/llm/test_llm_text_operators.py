"""BPE, personal data, token spans, language, chat and pages: brute force, round trips, edge cases."""

import hashlib
import json
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from songpulse.llm import bpe, chat, html_text, lang_id, pii, token_spans

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENGLISH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = [None, "", " ", "a", "thewas'sÀß 12é漢😀", "\n\n\t  x  \x1c\x85 y", "ab" * 5000, "the cat " * 3, "the cat " * 3, "%" * 300, "é" * 700]


def tokenizer(path):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, i) for i, t in enumerate(ODD)], "doc_id long, text string, ids long")


def test_bpe_matches_the_library_and_decodes(spark, odd):
    want = tokenizer(MULTI)
    rows = bpe.encode(odd, MULTI, PATTERN, decoded=True)
    for r in rows.collect():
        text = ODD[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == want.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
    back = {r["doc_id"]: r["text"] for r in bpe.decode(rows, MULTI).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe.encode(odd.limit(0), MULTI, PATTERN).count() == 0


def test_bpe_random_pieces_of_all_lengths():
    codec, want, rnd = bpe.Codec(bpe.load_ranks(MULTI), PATTERN), tokenizer(MULTI), random.Random(3)
    pieces = ["".join(rnd.choice("abcdetheinrsé") for _ in range(rnd.randrange(1, 400))) for _ in range(600)]
    for piece, ids in zip(pieces, codec.encode_pieces(p.encode() for p in pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(piece)


def test_bpe_long_pieces_in_matrices():
    codec, want, rnd = bpe.Codec(bpe.load_ranks(MULTI), PATTERN), tokenizer(MULTI), random.Random(5)
    pieces = ["a" * 100_000, "ab" * 50_001, "".join(rnd.choice("eainrstolä") for _ in range(100_000)), "é" * 777, "x" * 255 + "y" * 256]
    pieces += ["".join(rnd.choice("的一是不了人我在") for _ in range(rnd.randrange(1, 3000))) for _ in range(20)]
    for piece, ids in zip(pieces, codec.encode_pieces(p.encode() for p in pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(piece)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.text("abc", min_size=2, max_size=4), min_size=4, max_size=40, unique=True),
    st.lists(st.text("abc", max_size=60), min_size=1, max_size=12),
)
def test_bpe_ranks_in_any_order(tokens, pieces):
    """Vocabularies in which a merge may make a pair of smaller rank."""
    ranks = {bytes([b]): 200 + b for b in range(256)}
    ranks |= {t.encode(): i for i, t in enumerate(tokens)}

    def plain(piece):
        parts = [bytes([b]) for b in piece.encode()]
        while True:
            found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    codec = bpe.Codec(ranks, PATTERN)
    for piece, ids in zip(pieces, codec.encode_pieces(p.encode() for p in pieces), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(piece)


def test_bpe_long_text_in_runs(monkeypatch):
    codec, want = bpe.Codec(bpe.load_ranks(MULTI), PATTERN), tokenizer(MULTI)
    monkeypatch.setattr(bpe, "RUN_CHARS", 50)
    monkeypatch.setattr(bpe, "RUN_PIECES", 7)
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 20)
    text = "Ab'll é12 cd,,\n  x " * 40
    assert np.frombuffer(codec.encode(["q", text])[1], "<u4").tolist() == want.encode_ordinary(text)


def test_section_counts_match_token_offsets(spark, odd):
    want = tokenizer(ENGLISH)
    rows = token_spans.section_counts(odd, ENGLISH, PATTERN).collect()
    for i, text in enumerate(ODD):
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["section_no"])
        ids = want.encode_ordinary(text or "")
        assert sum(r["n_tokens"] for r in own) == len(ids) == own[0]["doc_tokens"]
        assert "".join((text or "")[r["start"] : r["end"]] for r in own) == (text or "")
        offsets = want.decode_with_offsets(ids)[1] + [len(text or "")]
        if text and text.isascii():
            for r in own:
                inside = [(a, b) for a, b in zip(offsets, offsets[1:], strict=False) if min(b, r["end"]) - max(a, r["start"]) > (b - a) / 2]
                assert len(inside) <= r["n_tokens"]


def test_section_rules_on_given_spans(spark):
    docs = spark.createDataFrame([(1, "hello world again", [(0, 2), (2, 9), (12, 14)]), (2, "x y", None)], "doc_id long, text string, s array<struct<start:int,end:int>>")
    got = lambda rule: {
        (r["doc_id"], r["section_no"]): (r["n_tokens"], r["n_crossing"])
        for r in token_spans.section_counts(docs, ENGLISH, PATTERN, spans="s", rule=rule).collect()
    }
    # Tokens: hello [0, 5), " world" [5, 11), " again" [11, 17).
    assert got("largest") == {(1, 0): (0, 0), (1, 1): (2, 2), (1, 2): (1, 1), (2, -1): (2, 0)}
    assert got("first") == {(1, -1): (1, 0), (1, 0): (1, 1), (1, 1): (1, 1), (1, 2): (0, 0), (2, -1): (2, 0)}
    with pytest.raises(ValueError):
        token_spans.section_counts(docs, ENGLISH, PATTERN, rule="other")


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            fine = {
                "email": True, "ip": kind == "ip" and max(map(int, m[0].split("."))) <= 255,
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15,
            }[kind]
            out += [(kind, m.start(), m.end())] * fine
    return out


def test_pii_base_spans_match_the_patterns():
    rnd = random.Random(5)
    bits = ["1", "2", "55", "4111111111111111", ".", " ", "-", "+", "(", ")", "@", "a", "b.c", "x@y.zz", "é", "1.2.3.4", "://", "token = ", "\n"]
    for _ in range(20_000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(25)))
        assert [s for s in pii.spans(text) if s[0] in pii.BASE_KINDS] == brute_spans(text), text


def test_pii_find_and_redact(spark):
    texts = [None, "", "mail a.b@c.de now", 'token = "abcdef0123456789abcdef"', "https://me:pw1@host.org/x", "9" * 50_000 + "."]
    docs = spark.createDataFrame([(i, t, 1, "kept") for i, t in enumerate(texts)] + [(None, "a@b.c", 1, "x")], "doc_id long, text string, n_chars long, pii string")
    found = {r["doc_id"]: [(s["kind"], s["text"]) for s in r["pii"]] for r in pii.find(docs).collect()}
    assert found[0] == found[1] == found[5] == [] and found[2] == [("email", "a.b@c.de")]
    assert found[3] == [("secret", "abcdef0123456789abcdef")]
    assert ("login", "me:pw1") in found[4]
    clean = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert clean[0]["text"] is None and clean[2]["text"] == "mail [EMAIL] now" and clean[2]["n_chars"] == 16
    assert clean[None]["text"] == "[EMAIL]" and clean[2]["pii"] == "kept"
    assert pii.redact(docs.limit(0)).columns == docs.columns and pii.find(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("password = Tr0ub4dor&3 next", [("secret", "Tr0ub4dor&3")]), ('{"PassWord": "two words, x"}', [("secret", "two words, x")]),
        ("passwd:'a\\'b' x", [("secret", "a\\'b")]), ("pwd='open x", [("secret", "open")]), ("password:\nNext line", []), ("a password is short", []),
        ("Api_Key=abcdefghij0123456789", [("secret", "abcdefghij0123456789")]), ("apiKey: abcdefghij0123456789", [("secret", "abcdefghij0123456789")]),
        ("ACCESS-KEY = abcdefghij0123456789", [("secret", "abcdefghij0123456789")]), ("İ tOKEN=abcdefghij0123456789", [("secret", "abcdefghij0123456789")]),
        ("token = short", []), ("IBAN: DE89 3704 0044 0532 0130 00 BANK", [("account", "DE89 3704 0044 0532 0130 00")]),
        ("iban=es9121000418450200051332,", [("account", "es9121000418450200051332")]), ("Account number: 12-345678 by", [("account", "12-345678")]),
        ("customer_id=\"C-99812\"", [("account", "C-99812")]), ("Customer No. 48213", [("account", "48213")]), ("account notes 12345", []),
        ("the account number is not known", []), ("an account no one had in 1999", []), ("accountid 123", []),
    ],
)
def test_pii_cues(text, want):
    assert [(k, text[s:e]) for k, s, e in pii.spans(text) if k not in pii.BASE_KINDS] == want


def test_language_codes_and_edges(spark):
    for n in (2, 4, 7, 12, 40):
        code = lang_id.codewords(n)
        apart = min(int((a != b).sum()) for i, a in enumerate(code) for b in code[:i])
        assert apart >= (1 if n == 2 else 2)
    words = {"xx": "ba be bi bo bu ", "yy": "kra kre kri kro ", "zz": "éla élé éli "}
    rows = [(i, w * (1 + i % 5), lang, lang) for i, (lang, w) in enumerate(list(words.items()) * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = lang_id.fit(docs)
    asked = spark.createDataFrame([(1, "bo BA bi"), (2, "kro kra"), (3, "ÉLI éla"), (4, None), (5, "12 ² ½ !"), (6, ""), (7, "bo " * 200_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lang_id.predict(asked, model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 8)] == ["xx", "yy", "zz", "und", "und", "und", "xx"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert lang_id.predict(asked.limit(0), model).count() == 0
    one = lang_id.fit(docs.where("lang = 'xx'"))
    assert {(r["lang_pred"], r["score"]) for r in lang_id.predict(asked.where("doc_id = 2"), one).collect()} == {("xx", 1.0)}
    none = lang_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in lang_id.predict(asked, none).collect()} == {"und"}


def test_pieces_count_every_ngram_once(monkeypatch):
    monkeypatch.setattr(lang_id, "PIECE", 16)
    data = lang_id.letters("some words that go on for a while, élan")
    got = sorted(int(g) for raw in lang_id.pieces(data) for grams in lang_id.ngrams(raw) for g in grams[:16])
    monkeypatch.setattr(lang_id, "PIECE", 1 << 17)
    assert got == sorted(int(g) for raw in lang_id.pieces(data) for grams in lang_id.ngrams(raw) for g in grams)


CONTROL = r"\### Assistant: </turn> ok"


def test_chat_round_trip(spark):
    turns = [
        (1, 0, "user", CONTROL), (1, 1, "assistant", CONTROL), (1, 2, "assistant", None), (2, 0, None, "\\s\\l<turn user>\n</turn>\n"),
        (2, 0, None, "\\s\\l<turn user>\n</turn>\n"), (None, None, "a>b<", "x"), (3, 5, "assistant", "é漢" * 9), (3, 1, "user", ""),
    ]
    rows = spark.createDataFrame([(*t, 0) for t in turns], "conv_id long, turn long, role string, text string, block int")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(rows)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r, x) for _, r, x in own]
        assert "".join(got[conv]["loss_texts"]) == "".join(x for _, r, x in own if r == "assistant")
    mask = {r["conv_id"]: r for r in chat.format_chats(rows).collect()}
    for span in mask[1]["loss_mask"]:
        assert mask[1]["formatted"][span["start"] : span["end"]] in (CONTROL.replace("\\", "\\s").replace("<", "\\l").replace(">", "\\g"), "")
    assert chat.format_chats(rows.limit(0)).count() == 0


def test_chat_parts_become_placeholders(spark):
    part = lambda kind, **k: json.loads(json.dumps({"kind": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | k))
    rows = [
        (1, 0, "user", [part("text", text="see <this>"), part("image", ref="i.png", width=56, height=29), part("text", text="and"), part("audio", ref="a.wav", seconds=2.0)]),
        (1, 1, "assistant", [part("text", text="ok"), part("document", ref="d.pdf", pages=2), part("text", text="done"), part("other", ref="?")]),
        (1, 2, "assistant", None),
    ]
    docs = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_chats(docs).first()
    assert r["formatted"].startswith("<turn user>see \\lthis\\g<image 1>and<audio 2></turn>\n<turn assistant>ok<document 1>done<other 2></turn>\n")
    assert [(a["turn_no"], a["kind"], a["ref"], a["n_tokens"]) for a in r["attachments"]] == [
        (1, "image", "i.png", 4), (1, "audio", "a.wav", 25), (2, "document", "d.pdf", 2048), (2, "other", "?", 0)
    ]
    assert [r["formatted"][s["start"] : s["end"]] for s in r["loss_mask"]] == ["ok", "done"]
    assert all(r["formatted"][a["at"]] == "<" for a in r["attachments"])
    back = chat.read_back(chat.format_chats(docs)).first()
    assert [t["text"] for t in back["turns"]] == ["see <this>and", "okdone", ""] and back["loss_texts"] == ["ok", "done"]


LONG = "Some long sentence of the article that says enough. " * 4


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<script>x</script>", ""),
        (f"<nav>menu</nav><article><h1>T</h1><p>{LONG}</p><p>Short.</p><div class='ad'>buy</div></article><footer>f</footer>", f"T\n\n{LONG.strip()}\n\nShort."),
        (f"<div id=top-menu>a</div><p><a href=x>home</a></p><div><p>{LONG}<br>x</p><p>mid</p><p>{LONG}</p></div><p>end</p>", f"{LONG}x\n\nmid\n\n{LONG.strip()}"),
        (f"<article><p>{LONG}<p>two<aside>side</article><div class=comments><p>{LONG}{LONG}</p></div>", f"{LONG.strip()}\n\ntwo"),
        (f"<article>{LONG}<form><p>sign up</form><!-- <p>no</p> --></article><article class='comment'>{LONG}{LONG}{LONG}</article>", LONG.strip()),
    ],
)
def test_main_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize(
    "before",
    ["<div class='content-sidebar-wrap'>", "<div class='page with-sidebar'>", "<div class='no-sidebar has-banner share-enabled'>", "<div class=sidebar>",
     "<form>", "<div class='ad'>", "<aside>side", "<nav><a>x", "<main><h1>x</h1><div class='ad'>"],
)
@pytest.mark.parametrize("after", ["</div></form>", ""])
@pytest.mark.parametrize("name", ["article", "main"])
def test_main_text_inside_a_wrapper(before, after, name):
    assert html_text.main_text(f"{before}<{name}><h1>T</h1><p>{LONG}</p><div class=ad>buy</div></{name}>{after}") == f"T\n\n{LONG.strip()}"


def test_names_of_sections_and_what_stays_out():
    long = LONG.strip()
    page = f"<article class='post tag-ad'><p>{LONG}</p><section id='related-work'><p>{LONG}</p></section><section id='search-syntax'><p>q</p></section></article>"
    assert html_text.main_text(page) == f"{long}\n\n{long}\n\nq"
    for junk in ("div class=related", "div class='sidebar'", "aside", "div class='comment-list'", "div id=cookie-box"):
        other = f"<{junk}><article><p>{LONG}{LONG}{LONG}</p></article></{junk.split()[0]}>"
        assert html_text.main_text(f"<article><p>{LONG}</p></article>{other}") == html_text.main_text(f"{other}<article><p>{LONG}</p></article>") == long
    assert html_text.main_text(f"<article><p>Short.</p><div class=comments><p>{LONG}</p><article>{LONG}</article></div></article>") == "Short."
    assert html_text.main_text(f"<div class=sidebar><div class=widget><p>{LONG}</p><p>{LONG}</p><div class=ad>{LONG}</div></div></div>") == f"{long}\n\n{long}"


@pytest.mark.parametrize("wrap", ["%s", "<body>%s</body>", "<div>%s</div>", "<body><ul><li><a>a</a><li><a>b</a><li><a>c</a><li><a>d</a></ul><div id=page><div>%s</div></div></body>"])
@pytest.mark.parametrize(
    ("inner", "shorts"),
    [
        ("<ul><li>one<li>two<li>three<li>four</ul>", ["one", "two", "three", "four"]),
        ("<table><tr><td>a<td>b</tr><tr><td>c<td>d</tr><tr><td>e<td>f</tr></table>", ["a b", "c d", "e f"]),
        ("<p>verse</p><p>verse</p><p>verse</p><p>verse</p>", ["verse"] * 4),
        ("<p><a href=x>one link</a></p><p><a href=y>two links</a></p><p><a>three links</a></p>", ["one link", "two links", "three links"]),
    ],
)
def test_main_text_over_short_blocks_and_to_its_ends(wrap, inner, shorts):
    page = wrap % f"<h1>Title</h1><p>By me</p><p>{LONG}</p>{inner}<h2>More</h2><p>{LONG}{LONG}</p><p>The end.</p>"
    more = f"{LONG}{LONG}".strip()
    assert html_text.main_text(page) == "\n\n".join(["Title", "By me", LONG.strip(), *shorts, "More", more, "The end."])


def test_main_text_takes_no_other_element():
    links = "".join(f"<p><a href=x>some link {i}</a></p>" for i in range(5))
    page = f"<div>{LONG}{links}</div><h1>Title</h1><div><p>{LONG}{LONG}</p><p>end</p></div><div>other</div>{links}"
    assert html_text.main_text(page) == f"Title\n\n{LONG}{LONG}".strip() + "\n\nend"
    sections = f"<div><section><p>{LONG}</p></section><ul><li>a<li>b<li>c<li>d</ul><section><p>{LONG}</p><p>end</p></section></div>"
    assert html_text.main_text(sections) == "\n\n".join([LONG.strip(), "a", "b", "c", "d", LONG.strip(), "end"])


def test_pages_keep_rows(spark):
    rows = spark.createDataFrame([(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<p>x", "t")], "page_id long, url string, html string, text string")
    assert sorted((str(r["page_id"]), r["text"]) for r in html_text.extract(rows).collect()) == [("1", ""), ("1", ""), ("None", "x")]
    assert html_text.extract(rows.limit(0)).count() == 0


def test_article_blocks_of_the_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = {r["page_id"]: r["html"] for r in rows.collect()}
    import html

    for r in html_text.extract(rows).collect():
        page = pages[r["page_id"]]
        inner = page[page.index("<article>") + 9 : page.rindex("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_digests_are_of_whole_texts(spark):
    from songpulse.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = tokenizer(MULTI)
    for r in QUERIES["op4_bpe_round_trip"](spark, "/root/testdata/sf0.001").collect():
        ids = want.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    for r in QUERIES["op8_find_pii"](spark, "/root/testdata/sf0.001").collect():
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e in brute_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    held = [r for r in QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").where("held_out").collect()]
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("text", [
    "Forgot your password: click here", "user password = yes and no", "pwd: /home/x", "pwd: ~/x2", "Password: see below.", "password: https://x.org/a1",
    "The password: case-sensitive, long.", "password :", "passwd: what?", "your password: really!",
])
def test_prose_about_passwords_keeps_its_words(text):
    assert pii.spans(text) == [] and pii.replaced(text, dict.fromkeys(pii.KINDS, "#")) == text


@pytest.mark.parametrize("text,value", [
    ("password: hunter2 next", "hunter2"), ("password=abc next", "abc"), ('password: "two words"', "two words"), ("pwd = a$b", "a$b"),
    ("password: abc1", "abc1"), ("passwd := x#", "x#"), ("PASSWORD=/etc", "/etc"),
])
def test_passwords_are_found(text, value):
    assert [text[a:b] for kind, a, b in pii.spans(text) if kind == "secret"] == [value]


@pytest.mark.parametrize("page", [
    '<p class="' * 100_000, "a<b " * 250_000, "<p x='" * 150_000, "<b x=\">" * 100_000 + "'", "<!--" * 200_000, "<" * 1_000_000,
    '<p class="a" ' * 80_000 + ">", "<script>" * 100_000,
])
def test_malformed_pages_take_linear_time(page):
    import time

    begin = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begin < 2


COMPOUNDS = (
    "ad-container ad-wrapper ad-slot ad-300x250 google-ad sponsored-content comments-area comment-body comments-section post-comments"
    " wp-comments main-nav main-menu menu-item widget-area primary-sidebar related-articles newsletter-form cookie-message social-icons"
    " article-footer page-footer site-footer comment-list advert-box ad_unit top-ad sidebar-left cookie-banner consent-popup share-buttons"
    " related-posts newsletter-signup promo-box breadcrumb-list site-nav footer-links reply-form comment-thread social-links adslot-2 entry-share"
).split()
WRAPPERS = (
    "content-sidebar-wrap with-sidebar no-sidebar has-banner share-enabled related-work search-syntax comments-open page-with-sidebar tag-ad"
    " advertising-history menu-options social-science notice-period article-body entry-content post-content"
).split()


@pytest.mark.parametrize("name", COMPOUNDS)
@pytest.mark.parametrize("wrap", ["article", "div"])
def test_compound_names_of_additions(name, wrap):
    page = f"<{wrap}><h1>T</h1><p>{LONG}</p><div class='{name}'><p>junk text</p></div></{wrap}>"
    assert html_text.main_text(page) == f"T\n\n{LONG.strip()}"


@pytest.mark.parametrize("name", WRAPPERS)
def test_compound_names_of_text(name):
    assert html_text.main_text(f"<article><h1>T</h1><section id='{name}'><p>{LONG}</p></section></article>") == f"T\n\n{LONG.strip()}"


def test_pages_off_the_beaten_track():
    long = LONG.strip()
    page = f"<h1>Title</h1><p>{LONG}</p><div class=comments-area><p>{LONG}</p></div><div class=page-footer><p>foot</p></div>"
    assert html_text.main_text(page) == f"Title\n\n{long}"
    assert html_text.main_text(f"<div><p>{LONG}</p></div><article><h1>Tiny</h1><p>Hi.</p></article>") == "Tiny\n\nHi."
    short = "<h1>Title</h1><p>short one</p><p>and two words</p><p>three</p><p>four</p><ul><li><a href=x>link a</a></li><li><a href=y>b</a></li></ul>"
    assert html_text.main_text(short) == "Title\n\nshort one\n\nand two words\n\nthree\n\nfour"
    two = f"<main><article><h2>A</h2><p>{LONG}</p></article><article><h2>B</h2><p>{LONG}{LONG}</p></article></main>"
    assert html_text.main_text(two) == f"A\n\n{long}\n\nB\n\n{' '.join((LONG + LONG).split())}"
    assert html_text.main_text("<h1>Only a title</h1>") == "Only a title"


def test_given_pages_without_article_tags_give_the_same_text(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert html_text.main_text(re.sub(r"</?article[^>]*>", "", r["html"])) == html_text.main_text(r["html"])


def test_long_pieces_are_kept_for_their_run_only():
    codec = bpe.Codec(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    texts = [f"{'ab' * 400}{i} small {'#' * 60}" for i in "abcdefgh"]
    first = codec.encode(texts)
    assert first == codec.encode(texts) == [codec.encode([t])[0] for t in texts]
    assert max(map(len, codec.remembered)) <= bpe.REMEMBERED_CHARS and b"".join(map(codec.decode, first)) == "".join(texts).encode()
