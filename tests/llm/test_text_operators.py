"""PII, secrets, pieces and HTML against plain versions."""

from __future__ import annotations

import hashlib
import html as stdhtml
import random
import re

import numpy as np
import pytest
from llm.edge_tables import CLASHING, SF, edge_documents, edge_texts

from ipcforge.llm import html_text, pieces, pii, secret_scan

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SECRETS = {"assign": r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
LEAST = {"assign": 12, "access": 18, "hex": 16}


def plain_pii(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    def ok(kind, found):
        digits = re.sub(r"[^0-9]", "", found)
        return (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in found.split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15)

    return [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, text) if ok(k, m.group())]


def plain_secrets(text):
    kinds = list(SECRETS)
    found = sorted((m.start(), kinds.index(k), m.end()) for k, p in SECRETS.items() for m in re.finditer(p, text)
                   if len(m.group(2) if k == "assign" else m.group()) >= LEAST[k])
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)


def _texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] for r in rows}


def test_pii_equals_the_patterns(spark):
    texts = _texts(spark)
    got = pii.pii_digest(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert len(got) == len(texts) and sum(r["n_email"] + r["n_card"] for r in got) > 0
    for r in got:
        base = plain_pii(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(pii.span_digest(base).encode()).hexdigest()


def test_pii_on_awkward_strings():
    rnd = random.Random(3)
    for _ in range(3000):
        text = "".join(rnd.choice(["@", ".", "a", "b@c.d", "+", "1", "23", " ", "-", "4111111111111111", "0.0.0.0", "256", "é", "(", "\n"])
                       for _ in range(rnd.randint(0, 30)))
        assert [s for s in pii.find_pii(text) if s[0] in pii.BASE] == plain_pii(text), text


def test_pii_method_spans():
    text = "IBAN: DE89 3704 0044 0532 0130 00 and SSN 123-45-6789, account no. 12345678; ftp://joe:pw@host.org/x tel:5551234567"
    kinds = [(k, text[a:b]) for k, a, b in pii.find_pii(text) if k not in pii.BASE]
    assert ("account", "DE89 3704 0044 0532 0130 00") in kinds and ("account", "123-45-6789") in kinds
    assert ("account", "12345678") in kinds and ("address", "tel:5551234567") in kinds
    assert pii.find_pii("iban: DE89 3704 0044 0532 0130 01") == []  # wrong remainder
    assert pii.redact("a@b.co!", pii.find_pii("a@b.co!")) == "[EMAIL]!"
    assert pii.find_pii("Plain prose about accounts and passports, nothing else.") == []
    assert pii.find_pii("9" * 5000 + ".1.1.1") == []


def test_secrets_equal_the_patterns(spark):
    texts = _texts(spark)
    awkward = ["password: token: abcdefghijklmnop", "AKIAAKIA" + "B" * 14, "a" * 15 + "g" + "a" * 16, "tokenſ=abcdefghijklmnop",
               "api_key='0123456789ab' apikey==x SECRET = a.b.c.d.e.f.g", "\U0001f642 passwd=\"zzzzzzzzzzzz\"", None, ""]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(awkward)], "doc_id long, text string"))
    texts |= {10**6 + i: t for i, t in enumerate(awkward)}
    for r in secret_scan.secret_digest(docs).collect():
        assert r["base_sha256"] == hashlib.sha256(plain_secrets(texts[r["doc_id"]] or "").encode()).hexdigest(), texts[r["doc_id"]]
        assert set(x for x in r["spans"].split(",") if not x.startswith("markov")) - {""} == set(plain_secrets(texts[r["doc_id"]] or "").split(",")) - {""}


def test_markov_tells_random_from_ordinary(spark):
    rnd = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secrets = ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(40)]
    prose = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("text").limit(60).collect()]
    known = [(i, t + f" token = {''.join(rnd.choice(letters) for _ in range(40))}") for i, t in enumerate(prose)]
    docs = spark.createDataFrame(known, "doc_id long, text string")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    tests = spark.createDataFrame([(i, f"see {s} there") for i, s in enumerate(secrets)] + [(100, "internationalization_of_the_thing"), (101, "hello-world-and-hello-again")],
                                  "doc_id long, text string")
    found = {r["doc_id"]: r["secret_spans"] for r in secret_scan.with_secrets(tests, model).collect()}
    assert sum(bool(found[i]) for i in range(40)) >= 36
    assert not found[100] and not found[101]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    coder = pieces.Coder(pieces.Vocabulary.load(pieces.model_path()))
    for text in [t for t in list(_texts(spark).values())[:60] + edge_texts()[3:] if "▁" not in t]:
        assert np.frombuffer(coder.encode(text), "<i4").tolist() == library.encode(text)


def test_pieces_stream_and_round_trip():
    v = pieces.Vocabulary.load(pieces.model_path())
    coder, rnd = pieces.Coder(v), random.Random(1)
    for _ in range(200):
        text = "".join(rnd.choice("ab the▁\n é日🙂x  \0") for _ in range(rnd.randint(0, 60)))
        assert coder.decode(np.frombuffer(coder.encode(text), "<i4").tolist()) == text
        marked, search, got, at = text.replace(" ", pieces.MARK), pieces.StreamingViterbi(v), [], 0
        while at < len(marked):
            step = rnd.randint(1, 9)
            got += search.feed(marked[at:at + step])
            at += step
        got += search.finish()
        once = pieces.StreamingViterbi(v)
        assert got == once.feed(marked) + once.finish()
    search = pieces.StreamingViterbi(v)
    early = search.feed("thereinthe" * 20000)
    assert len(early) > 50000 and search.widest < 10 * v.longest  # committed on the way, bounded window


def test_pieces_table(spark):
    docs = edge_documents(spark)
    rows = pieces.pieces_digest(docs).collect()
    assert len(rows) == docs.count() and all(r["round_trip"] for r in rows)
    assert {r["n_ids"] for r in rows if r["doc_id"] in (0, 1, 99)} == {0}
    both = pieces.decode(pieces.encode(docs))
    assert set(docs.columns) <= set(both.columns) and both.where("decoded = coalesce(text, '')").count() == docs.count()
    whole = {(r["doc_id"], r["n_ids"], r["ids_crc32"]) for r in rows}
    assert {(r["doc_id"], len(r["ids"]), r["ids_crc32"]) for r in both.select("doc_id", "ids", "ids_crc32").collect()} == whole


def test_main_text_of_the_pages(spark):
    for r in html_text.html_digest(spark.read.parquet(f"{SF}/pages.parquet")).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = (" ".join(stdhtml.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:h1|p)\b[^>]*>", inner))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>one <b>word</b>", "one word"), ("no tags &amp; all", "no tags & all"),
    ("<nav><a>menu</a></nav><script>var x='<p>no</p>'</script>", ""),
    ("<div><p>" + "long text " * 20 + "</p><p>short</p></div><div class='sidebar'><p>" + "noise " * 40 + "</p></div>",
     ("long text " * 20).strip() + "\nshort"),
    ("<article><h1>T</h1><p>body text here</p><div class='comments'><p>first!</p></div><form><p>mail</p></form></article><footer>f</footer>",
     "T\nbody text here"),
    ("<article><header><h1>T</h1></header><p>x &lt;y&gt;</p><ul><li>a<li>b</ul><div hidden>h</div></article>", "T\nx <y>\na\nb"),
    ("<div class=main><p>one<p class=ad>buy<p>two</div>", "one\ntwo"),
    ("<!-- c --><p>" + "a&nbsp;b \n c" + "</p><", "a b c\n<"),
    ("<html><head><title>T</title><body><p>text", "text"),
    ("<head><title>T</title><style>p {}</style><noscript><img src=x></noscript><script>1</script><p>text", "text"),
    ("<head><meta charset=utf-8><title>T</title>plain text<p>more", "plain text\nmore"),
    ("<!doctype html><title>A title</title><p>text", "text"),
    ("<div class='content has-sidebar'><p>text</p></div><div class='no-sidebar'><p>more</p></div>", "text\nmore"),
    ("<article class='post social'><h1>T</h1><h2 id='related-work'>Related work</h2><p>text here</p><h2 id=search>Search</h2></article>",
     "T\nRelated work\ntext here\nSearch"),
    ("<form id=aspnetForm><nav>menu</nav><p>all of the text</p><div class=sidebar><p>aside</p></div></form><div>foot</div>",
     "all of the text\nfoot"),
    ("<div class='page social'><h1>Title</h1><p>" + "text " * 20 + "</p></div>", "Title\n" + ("text " * 20).strip()),
    ("<div id=content><h1>T</h1>" + ("<p>" + "text " * 30 + "</p>") * 3 + "</div>" + "<article><a><b><i>card</i></b></a></article>" * 3,
     "T\n" + "\n".join([("text " * 30).strip()] * 3)),
    ("<div><p>one line of text</p></div><article>" + ("<p>" + "text " * 30 + "</p>") * 3 + "</article>", "\n".join([("text " * 30).strip()] * 3)),
    ("<h1>Title</h1><p>short text</p><div class=comments><p>" + "reply " * 20 + "</p></div>", "Title\nshort text"),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_pages_with_nulls_and_other_columns(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>hi</p>", "y")],
                                  "page_id long, url string, html string, text string")
    got = html_text.with_main_text(pages)
    assert sorted(r["text"] for r in got.collect()) == ["", "", "hi"] and got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert html_text.html_digest(pages.limit(0)).count() == 0


def test_edges_of_pii_and_secrets(spark):
    docs = edge_documents(spark)
    a, b = pii.pii_digest(docs), secret_scan.secret_digest(docs)
    assert a.count() == b.count() == docs.count()
    none = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in a.where("doc_id in (0, 1, 99)").collect()} == {none}
    row = a.where("doc_id = 9").first()
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    assert (b.where("doc_id = 10").first()["n_assign"], b.where("doc_id = 10").first()["n_access"], b.where("doc_id = 10").first()["n_hex"]) == (1, 1, 1)
    assert set(CLASHING) <= set(pii.with_pii(docs).columns)
    assert pii.with_pii(docs, redacted_col="text").where("doc_id = 9").first()["text"].startswith("mail [EMAIL] or [PHONE]")
    assert pii.pii_digest(docs.limit(0)).count() == secret_scan.secret_digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_added_spans_overlap_no_other(seed):
    rnd = random.Random(seed)
    spans = [(a, a + rnd.randint(1, 9)) for a in (rnd.randint(0, 80) for _ in range(rnd.randint(0, 14)))]
    free = pii._gaps(spans)
    for _ in range(300):
        a = rnd.randint(0, 90)
        b = a + rnd.randint(1, 9)
        assert free(a, b) == (not any(a < y and x < b for x, y in spans))


def test_secret_sample_with_null_and_repeated_keys(spark):
    """Null keys are chosen by their texts, repeated rows once, so the bound of the sample holds."""
    some = spark.range(4000).selectExpr("cast(null as long) as doc_id", "concat('ident', id, 'x') as text")
    same = spark.range(4000).selectExpr("7L as doc_id", "'repeated_identifier' as text")
    got = secret_scan.labelled_samples(some.unionByName(same), sample_docs=200).collect()
    assert 120 < len(got) < 300 and sum(r["run"] == "repeated_identifier" for r in got) <= 1
