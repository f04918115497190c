"""Operators on single texts against plain versions, libraries, round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from scorekeep.llm import edit_fingerprint as ef
from scorekeep.llm import html_text, packing, personal_data, url_filter
from scorekeep.llm.language_id import identify_languages
from scorekeep.llm.queries import ORACLE_SQL, QUERIES
from scorekeep.llm.sentencepiece_codec import Codec, checked_pieces, decode_pieces, encode_pieces
from tests.conftest import SF_SMALL
from tests.llm.conftest import words

ODD = ["It's we'll 1234 a1b2", "été naïve ﬁ Σίσυφος", "<|endoftext|> x", "日本語 テスト　全角", "a b c \x0bq", "😀😀 ok", "İstanbul ẞß ª",
       "", "  two  spaces ", "'' '", "x́ ́y", "12³½Ⅳ\n\nline"]


def _texts():
    import pyarrow.parquet as pq
    return pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["text"]).column(0).to_pylist()


def test_every_operator_is_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "substring_dedup", "personal_data",
                                                      "best_fit_packing"]


def test_url_filter_matches_sql(spark):
    import duckdb
    rows = [(1, None), (2, ""), (3, "nocolon"), (4, "http://Example.ORG/es/x"), (5, "http://example.org"), (6, "http://a.example.org/en/12?q"),
            (7, "http://xexample.org/es/"), (8, "ftp://b.com/fr/#x"), (9, "http://c.net/ADS/x"), (None, "http://c.net/banner/q/x.gif"),
            (11, "http://org/"), (12, "http://example.org?/es/"), (13, "http://c.net/x?affiliate=1"), (13, "http://c.net/x?affiliate=1")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"rule": F.lit(1), "token": F.lit(2), "host": F.lit(3)})
    got = url_filter.filter_urls(df, url_filter.rule_table(spark))
    key = lambda r: str(tuple(r))
    expected = set(map(key, con.execute(ORACLE_SQL["op2_url_filter"]).fetchall()))
    assert set(map(key, got.collect())) == expected and got.count() == len(rows)
    assert url_filter.filter_urls(df.where("false"), url_filter.rule_table(spark)).count() == 0
    bare = url_filter.rule_table(spark, [], [("block", "*x*")])  # a rule without a whole token runs on every url
    assert {r.verdict for r in url_filter.filter_urls(df.where("page_id = 9"), bare).collect()} == {"block"}
    assert {r.verdict for r in url_filter.filter_urls(df, url_filter.rule_table(spark, [], [])).collect()} == {"allow"}


def test_html_text(spark):
    rows = [
        (1, "<html><head><title>t</title></head><body><nav><a href=x>Home</a></nav><article><h1>T &amp; x</h1><p>one   two\n three"
            "<p>four <b>b</b><div class='ad'>buy</div><ul><li>i1<li>i2</ul></article><aside>s</aside><footer>f</footer></body></html>",
         "T & x\none two three\nfour b\ni1\ni2"),
        (2, "<div id='cookie-notice'>We use cookies</div><header>h</header><div class=content><p>" + "long text " * 30 + "</div>"
            "<div class=comments><p>nice</div><form>q</form>", ("long text " * 30).strip()),
        (3, None, ""), (4, "", ""), (5, "a<script>if(a<b){'</p>'}</script>b<!-- x --> c", "ab c"), (6, "<nav>x</nav>", ""),
        (7, "1 &lt; 2 &#233; &am", "1 < 2 é &am"), (8, "<p>" * 5000 + "deep", "deep"), (None, "<p>x", "x")]
    df = spark.createDataFrame([(a, f"u{a}", b) for a, b, _ in rows], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_text.extract_text(df).collect()}
    assert {a: got[a].text for a, _, _ in rows} == {a: c for a, _, c in rows}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_language_id(spark, docs_of):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = identify_languages(docs_of([(1, None), (2, ""), (3, "12 %"), (None, "the"), (5, "the cat", None)])).collect()
    assert {r.lang_pred for r in odd if r.doc_id in (1, 2, 3)} == {"und"} and len(odd) == 5
    assert identify_languages(docs_of([])).count() == 0


def _base(text):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")), "phone": 10 <= len(d) <= 15,
                "card": 14 <= len(d) <= 19 and luhn}[kind]

    found = [(m.start(), i, m.end()) for i, k in enumerate(plain) for m in re.finditer(plain[k], text or "") if valid(k, m.group())]
    return ",".join(f"{personal_data.KINDS[i]}:{a}:{b}" for a, i, b in sorted(found))


def test_personal_data(spark, docs_of):
    texts = ["a@b.c+d@e.f x@y.z_w@q.r a@b.c@d.e @@a@b..c a@b.c.", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.2.3 " + "9" * 30 + ".1.1.1",
             "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500000000000004", "+1 (555) 123-4567 ++44 20 7946 0958 +1- +12345",
             "9" * 20_000 + " " + "a" * 20_000 + "@", "😀a@b.co 😀1.2.3.4", "", None, "1 " * 5000]
    texts += [f"please write to user{i}@mail.example.com today" for i in range(12)] + ["please write to user99(at)mail.example.com today"]
    docs = docs_of([*enumerate(texts), (3, texts[3]), (None, "b@c.de")])
    got = personal_data.personal_data(docs)
    listed = {r.doc_id: r for r in got.select("doc_id", personal_data._listed(F.col("base")).alias("base"),
                                             personal_data._listed(F.col("spans")).alias("spans")).collect()}
    assert {i: listed[i].base for i in range(len(texts))} == {i: _base(t) for i, t in enumerate(texts)}
    assert listed[len(texts) - 1].spans == "email:16:42" and listed[None].base == "email:0:6" and got.count() == len(texts) + 2
    clear = corpus_pipeline.mask_personal_data(spark, docs.where("doc_id = 5"), "").first()
    assert clear.text == "😀[EMAIL] 😀[IP]" and clear.n_chars == len(clear.text) and clear.spans == "x"
    assert personal_data.personal_data(docs_of([])).count() == 0


def test_sentencepiece(spark, docs_of):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # the library's own Viterbi over the same pieces and scores
    for p in model.pieces:
        p.score = max(p.score, -40_000.0)  # sums at -1e9 are beyond the library's float precision
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    codec, score = Codec(path), lambda ids: sum(model.pieces[i].score for i in ids)
    texts = [t.replace("\n", " ") for t in _texts()[:60]]
    # equally good segmentations may differ, and the library adds up in float
    assert all(abs(score(codec.encode(t)) - score(library.encode(t))) <= 1e-4 * abs(score(library.encode(t))) for t in texts)
    rows = [*enumerate([*ODD, *_texts()[:20], "y" * 50_000]), (900, None), (901, "")]
    got = decode_pieces(encode_pieces(docs_of([*rows, (None, "x")]), path), path).collect()
    assert all(r.decoded == r.text for r in got) and len(got) == len(rows) + 1
    assert [r.ids for r in got if r.doc_id in (900, 901)] in ([None, []], [[], None])
    # words that go through the automaton together have the ids of each alone
    assert all(list(codec.encode(t)) == list(codec.viterbi(codec.prefix + t.replace(" ", "▁"))) for t in [*ODD[1:], *_texts()[:20]] if t)
    both_ways = checked_pieces(docs_of([*rows, (None, "x"), (7, "x")]), path).collect()
    hashed = {(r.doc_id, tuple(r.ids or ()), hashlib.sha256(r.text.encode()).hexdigest() if r.text is not None else None) for r in got}
    assert all(r.exact for r in both_ways) and len(both_ways) == len(got) + 1
    assert hashed <= {(r.doc_id, tuple(r.ids or ()), r.decoded_sha256) for r in both_ways}
    assert checked_pieces(docs_of([]), path).count() == 0


def _plain_print(walker, text):
    moves = (ef.mix(np.arange(ef.CLASSES * ef.PERIOD, dtype=ef.U) + ef.U(0x5851F42D4C957F2D)) >> ef.U(63) == 1).reshape(ef.CLASSES, -1)
    moves[:, -1] = True
    codes = [ord(c) for c in text]
    kinds, y, i, j = (ef.mix(np.array(codes, ef.U) + ef.U(77)) >> ef.U(58)).astype(int), [], 0, 0
    while i < len(codes):
        y.append(codes[i])
        i += moves[kinds[i], j % ef.PERIOD]
        j += 1
    bits = []
    for s in range(ef.BITS if y else 0):
        place = max(int(r) for r in walker.records[s] if r < len(y))
        bits.append(int(ef.mix(np.array([y[place] * ef.BITS + s], ef.U))[0] >> ef.U(63)))
    return np.packbits(np.array(bits or [0] * ef.BITS, bool)).tobytes().hex()


def test_fingerprints(docs_of):
    rows = [(3 * i, t) for i, t in enumerate([*ODD, *_texts()[:12], "ab" * 20_000, None])] + [(None, "first"), (7000, "same text"), (7001, "same text")]
    got = {r.doc_id: r for r in ef.edit_fingerprints(docs_of(rows)).collect()}
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    walker = ef.Walker()
    for (i, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if len(text) < 5000:
            assert got[i].fingerprint == _plain_print(walker, text) and got[i].edited_fingerprint == _plain_print(walker, edited)
    assert got[7000].fingerprint == got[7001].fingerprint and got[7000].near_next == 1.0
    long = [r for r in got.values() if r.n_chars > 500 and r.doc_id != 7000]
    assert np.mean([r.near_edited for r in long]) > 0.3 > np.mean([r.near_next for r in long])
    assert ef.edit_fingerprints(docs_of([])).collect() == []


def test_near_duplicates_by_fingerprint(docs_of):
    base = [" ".join(words(i, 300)) for i in range(12)]
    rows = [(i, b) for i, b in enumerate(base)] + [(20 + i, b.replace(b[300:310], "0123456789")) for i, b in enumerate(base)] + [(50, None)]
    prints = ef.edit_fingerprints(docs_of(rows)).cache()
    bits = {r.doc_id: np.unpackbits(np.frombuffer(bytes.fromhex(r.fingerprint), np.uint8)) for r in prints.collect()}
    got = {r.doc_id: r.component_id for r in ef.near_duplicates(prints).collect()}
    near = {20 + i for i in range(12) if ef.likeness(bits[i], bits[20 + i]) >= 0.8}
    assert len(near) >= 9 and got == {i: i - 20 if i in near else i for i in bits}


def test_packing(spark, docs_of):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [*enumerate([*ODD, *_texts()[:40], "zq " * 20_000]), (900, None), (900, None), (None, "x y")]
    got = packing.pack_documents(docs_of(rows), path).collect()
    expected = []
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected += [(i, k, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    sequences = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert sequences.get(r.sequence_id, 0) == r.offset
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 4096 and len(sequences) <= -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack_documents(docs_of([]), path).count() == 0


def test_local_search_empties_bins():
    r, better = random.Random(1), 0
    for low, high, capacity in ((1, 60, 100), (26, 52, 100), (10, 30, 50)):
        lengths = [r.randint(low, high) for _ in range(200)]
        start = packing.best_fit(lengths, capacity)
        end = packing.local_search([list(b) for b in start], lengths, capacity)
        assert sorted(i for b in end for i in b) == list(range(200)) and max(sum(lengths[i] for i in b) for b in end) <= capacity
        assert -(-sum(lengths) // capacity) <= len(end) <= len(start)
        better += len(start) - len(end)
    assert better > 0


def test_packing_in_rounds(spark, docs_of):
    r = random.Random(2)
    rows = [(i, 0, 0, r.randint(1, 60), 0) for i in range(700)]
    pieces = spark.createDataFrame(rows, packing._PIECE)
    got = packing.pack_pieces(pieces, 100, group=100).collect()
    fill = {}
    for x in got:
        fill[x.sequence_id] = fill.get(x.sequence_id, 0) + x.length
    assert len(got) == 700 and max(fill.values()) <= 100 and len(fill) <= 1.02 * sum(x[3] for x in rows) / 100 + 1


def test_pipeline(spark, docs_of):
    passage = " ".join(" ".join(words(s, 8)).capitalize() + "." for s in range(8))
    english = _texts()[0]
    rows = [(i, english[:200] + " " + " ".join(words(i, 60)) + ".", "en") for i in range(20)]
    rows += [(100, rows[0][1], "en"), (101, "12 34", "en"), (102, None, "en"), (103, rows[3][1] + " " + passage + " Mail a.b@c.example now.", "en"),
             (104, rows[4][1] + " tail. " + passage, "en"), (None, "the of and", "en")]
    docs = docs_of(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {*range(20), 103, 104, None}  # a row without an id is a document, too
    middle = passage.split(". ")[4]
    assert middle in kept[103] and middle not in kept[104] and "[EMAIL]" in kept[103] and "a.b@c" not in kept[103]
    assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, "").collect()} == set(kept)
