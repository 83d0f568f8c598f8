"""Models on held-out rows, token counts and files against the library, archives as round trips."""

import gzip
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolith.llm import archives, files, quality, secrets, tokencounts, tokenfiles, toxicity
from recolith.llm.common import fresh_path

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, path string"
ODD = [None, "", " \n\t", "It's A test, isn't it? e.g. 3.14, a,b ... x!.", "<|endoftext|> a <|ENDOFTEXT|>b <| c", "É é ΣΑΣ  x y \x1cz", "日本語のテキスト。中文", "a" * 5000, "word, " * 4000, "\x00\x7f \x85", "don't you'LL we'Re"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(ODD)] + [(None, "null id", "x", "y"), (3, ODD[3], "x", "y")], DOCS)


def test_base_statistics():
    def slow(text):
        w = text.encode().split()
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines, dup = set(), 0
        for x in text.split("\n"):
            if x.encode().split():
                dup += x in lines
                lines.add(x)
        return len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)

    draw = random.Random(1)
    for n in [0, 3, 4, 5, 6, 40, 200]:
        for _ in range(20):
            text = "".join(draw.choice(["a", "é", "#b", "|"]) + draw.choice([" ", "\n", " ", "\x0b"]) for _ in range(n))
            assert quality.base_statistics(text) == slow(text)


def test_hashed_features_follow_words_alone():
    h = quality.Hasher()
    a, b = h.parts("one two  three"), h.parts("\tone two\nthree ")
    assert (a[1] == b[1]).all() and (a[2] == b[2]).all() and len(a[1]) == 3 and len(a[2]) == 2
    assert [len(p) for p in h.parts("")] == [0, 0, 0] and len(h.parts("x" * 100_000)[0]) == 99_998


def test_quality_separates_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    odd = F.col("doc_id") % 2 == 1
    model = quality.train(docs, labels.where(odd))
    scored = quality.score(docs, model).join(labels.where(~odd), "doc_id").where("NOT base_failed").collect()
    good = [r["probability"] for r in scored if r["quality"] == 1]
    bad = [r["probability"] for r in scored if r["quality"] == 0]
    assert np.mean(np.array(good) >= quality.THRESHOLD) > 0.97 and np.mean(bad) < np.mean(good) - 0.3


def test_quality_has_the_labels_shares_whatever_the_sample(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id").select("doc_id", "text", "quality")
    share = known.agg(F.avg("quality")).first()[0]
    for rows in (400, 10_000):  # as many rows of each class, and all
        scored = quality.score(known, quality.train(docs, labels, rows_per_class=rows)).agg(F.avg("probability")).first()[0]
        assert abs(scored - share) < 0.05


def test_quality_on_odd_tables(spark, docs):
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 0), (2, 1)], "doc_id long, quality int")
    got = quality.digest(docs, labels).collect()
    assert len(got) == docs.count() and all(r["base_failed"] for r in got if r["n_words"] == 0)
    assert quality.digest(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    assert quality.digest(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_toxicity_separates_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    english = docs.join(labels, "doc_id").where("lang = 'en'").select("doc_id", "toxic")
    got = toxicity.digest(docs, labels).join(english, "doc_id").where("held_out").collect()
    caught = [r["predicted"] for r in got if r["toxic"] == 1]
    clean = [r["predicted"] for r in got if r["toxic"] == 0]
    assert np.mean(caught) > 0.75 and np.mean(clean) < 0.02  # one toxic text in eight here has no toxic word
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_learning_is_bounded_and_knows_its_columns(spark):
    """A labelled id that stands for many documents, long texts, and documents with the columns of labels and of a path in their names."""
    from recolith.llm import labelled

    rows = [(1, f"good text {i}", 0, "x", i) for i in range(50)] + [(2, f"bad text {i}", 1, "x", i) for i in range(50)] + [(3, "y" * 5000, 0, "x", 0), (None, "z", 1, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, `a.b` string, __id int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (3, None, 7), (9, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got, totals = labelled.sample(docs, labels, "doc_id", "text", "quality", 20)
    assert Counter(r["label"] for r in got.collect()) == Counter({0: 20, 1: 20}) and totals == {0: 1, 1: 3}
    got, _ = labelled.sample(docs, labels, "doc_id", "text", "quality", 100, bytes_per_class=200)
    size = Counter()
    for r in got.collect():
        size[r["label"]] += len(r["text"])
    assert all(180 < n <= 200 for n in size.values()) and set(size) == {0, 1}
    assert toxicity.digest(docs, labels).count() == len(rows) and quality.digest(docs, labels).count() == len(rows)
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_quality_verdicts_follow_the_rules(spark, docs):
    """base_failed and kept of the query, from a slow count."""
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choices(["a", "b", "c"] if i % 2 else [f"w{j}" for j in range(500)], k=draw.randint(0, 40)))) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    for r in quality.digest(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect():
        w = rows[r["doc_id"]][1].split()
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        repeated = len({j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)})
        failed = len(w) < 10 or 100 * repeated > 20 * len(w)
        assert (r["n_words"], r["n_repeat_words"], r["base_failed"]) == (len(w), repeated, failed)
        assert r["kept"] == (not failed and r["probability"] >= quality.THRESHOLD)


def test_quality_probabilities_are_calibrated(spark):
    """In bins of probability the share of good rows is near the mean, on rows that were not learnt from."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    odd = F.col("doc_id") % 2 == 1
    scored = quality.score(docs, quality.train(docs, labels.where(odd))).join(labels.where(~odd), "doc_id").select("probability", "quality").collect()
    p, y = np.array([r[0] for r in scored]), np.array([r[1] for r in scored])
    bins = [(p >= a) & (p < b) for a, b in ((0, 0.2), (0.2, 0.8), (0.8, 1.01))]
    gap = sum(b.sum() * abs(p[b].mean() - y[b].mean()) for b in bins if b.any()) / len(p)
    assert gap < 0.05


def test_toxicity_of_very_long_words():
    long = b"x" * 10_000
    parts = toxicity.windows([b"a", long, b"b"])
    assert all(len(p) <= toxicity.MOST for p in parts) and sum(map(len, parts)) >= len(long) and parts[0].startswith(b" a x") and parts[-1].endswith(b"x b ")
    assert all(a[-toxicity.OVERLAP :] == b[: toxicity.OVERLAP] for a, b in zip(parts, parts[1:], strict=False))


def test_toxicity_on_odd_tables(spark, docs):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 0), (6, None), (7, 1), (9, 0), (10, 1)], "doc_id long, toxic int")
    assert toxicity.digest(docs, labels).count() == docs.count()
    assert toxicity.digest(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.digest(docs.limit(0), labels).count() == 0


def test_secret_patterns(spark):
    text = "é Password: 'abcdef' token=abc secret = \"x/y+z_-.=1\" api_key:abcdefg AKIA" + "A1" * 8 + " AKIAX " + "0a" * 12 + " " + "0a" * 11
    spans = secrets.base_spans(text)
    assert [(secrets.KINDS[k], text[s:e]) for s, k, e in spans] == [("assign", "Password: 'abcdef"), ("assign", 'secret = "x/y+z_-.=1'), ("assign", "api_key:abcdefg"), ("access", "AKIA" + "A1" * 8), ("hex", "0a" * 12)]
    # a match that fails takes its text with it; other alphabets' look-alikes are no keywords
    assert secrets.base_spans("token=a:secret=abcdefg") == [(8, 0, 22)] and secrets.base_spans("\u017fecret=abcdefg to\u212aen=abcdefg") == []


def test_secret_patterns_against_a_slow_walk():
    """Base spans of random strings, the counts and their digest's text, by a walk over characters."""
    key, word = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"), ("password", "passwd", "secret", "token", "apikey", "api_key")

    def run(text, at, chars):
        end = at
        while end < len(text) and text[end] in chars:
            end += 1
        return end

    def assign(text, at):
        """End and length of group 2 of the match at the place, or None. Regular expressions give back what they took: here only the quotes are optional."""
        for w in word:
            if text[at : at + len(w)].lower() == w and text[at : at + len(w)].isascii():
                i = at + len(w)
                i += text[i : i + 1] in ('"', "'")
                i = run(text, i, " ")
                if text[i : i + 1] in (":", "="):
                    i = run(text, i + 1, " ")
                    i += text[i : i + 1] in ('"', "'")
                    end = run(text, i, key)
                    if end > i:
                        return end, end - i
        return None

    def slow(text):
        spans, at = [], 0
        while at < len(text):
            found = assign(text, at)
            if found:
                spans += [(at, 0, found[0])] if found[1] >= 6 else []
                at = found[0]
            else:
                at += 1
        for kind, start, chars, least in ((1, "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), (2, "", set("0123456789abcdef"), 24)):
            at = 0
            while at < len(text):
                end = run(text, at + len(start), chars) if text.startswith(start, at) else at
                if end > at + len(start):
                    spans += [(at, kind, end)] if end - at >= least else []
                    at = end
                else:
                    at += 1
        return sorted(spans)

    draw = random.Random(21)
    bits = ["password", "Token", "SECRET", "api_key", "apikey", "passwd", "=", ":", " ", "'", '"', "AKIA", "A1B2" * 4, "0a1b" * 6, "ab", "ffff", "é", "x-y/z", "\n", "ſ", "="]
    for _ in range(400):
        text = "".join(draw.choices(bits, k=draw.randint(0, 40)))
        assert secrets.base_spans(text) == slow(text)


def test_markov_spans_are_what_base_spans_leave(spark):
    model = secrets.trained(spark)
    draw = random.Random(5)
    key = lambda n: "".join(draw.choices(secrets.ALPHABET[:62], k=n))
    for _ in range(200):
        text = " ".join(draw.choice([key(30), "token=" + key(10), "0a1b" * 7 + key(20), "plain words", "é" + key(16) + "é"]) for _ in range(6))
        base = secrets.base_spans(text)
        covered = {i for s, _, e in base for i in range(s, e)}
        expected, at = [], 0
        while at < len(text):
            end = at
            while end < len(text) and end not in covered and text[end] in secrets.ALPHABET:
                end += 1
            if end - at >= secrets.MIN_TOKEN and model.ratio(text[at:end]) > secrets.THRESHOLD:
                expected.append((at, 3, end))
            at = max(end, at + 1)
        assert secrets.markov_spans(text, model, base) == expected
    letters = "".join(draw.choices(secrets.ALPHABET[:52], k=40))
    assert secrets.markov_spans(f"a {letters} b", model, []) == [(2, 3, 42)]
    # in proportion to the length, with many spans and a token of a megabyte
    text = "token=abcdefgh " * 100_000 + "x" * 1_000_000
    assert len(secrets.base_spans(text)) == 100_000 and len(secrets.markov_spans(text, model, secrets.base_spans(text))) <= 1


def test_markov_models_know_identifiers(spark):
    model = secrets.trained(spark)
    ordinary = ["passwordResetToken2023", "getElementsByClassName", "AbstractSingletonProxyFactoryBean", "internationalization", "/usr/local/lib/python3/dist-packages", "2024-01-01T00-00-00", "0123456789012345", "-" * 40, "Donaudampfschifffahrtsgesellschaft", "thequickbrownfoxjumps1"]
    assert all(model.ratio(t) <= secrets.THRESHOLD for t in ordinary)


def test_markov_models_separate_new_samples(spark):
    model = secrets.trained(spark)
    new = secrets.labelled_samples(500, seed=1234)
    found = np.array([model.ratio(t) > secrets.THRESHOLD for t, _ in new])
    label = np.array([y == 1 for _, y in new])
    assert found[label].mean() > 0.97 and found[~label].mean() < 0.01


def test_secret_scan_on_odd_tables(spark, docs):
    more = docs.unionByName(spark.createDataFrame([(99, "key Zx8Qv1Lk29TbYw7RmPq0 and password=Zx8Qv1Lk29TbYw7RmPq0, max_retry_count_2024_default", "x", "y")], DOCS))
    got = {r["doc_id"]: r for r in secrets.digest(more).collect()}
    assert got[99]["spans"] == "markov:4:24,assign:29:58" and (got[99]["n_assign"], got[99]["n_markov"]) == (1, 1)
    assert got[0]["spans"] == "" and got[1]["spans"] == "" and secrets.digest(docs.limit(0)).count() == 0


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokencounts.vocabulary()).encode(text or "", add_special_tokens=False).ids


def test_token_counts(spark, docs):
    got = tokencounts.digest(docs).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = "null id" if r["doc_id"] is None else ODD[r["doc_id"]]
        n = len(library_ids(text))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((text or "").encode()), n > 2048)
    assert tokencounts.digest(docs.limit(0)).count() == 0


def test_other_tokenizers_are_given_texts_whole(spark, docs):
    """Whatever a file's normaliser and splitter are, and a sentencepiece model too, counts are the library's."""
    import os

    import sentencepiece
    from tokenizers import Tokenizer

    folder = os.path.dirname(tokencounts.vocabulary())
    names = sorted(os.listdir(folder))
    others = [n for n in names if n.endswith(".json") and n != "word_bpe_49k.json" and b'"model"' in open(f"{folder}/{n}", "rb").read()][:2] + [n for n in names if n.endswith(".model")][:1]
    for name in others:
        path = f"{folder}/{name}"
        if name.endswith(".model"):
            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            count = lambda t, p=processor: len(p.encode(t))
        else:
            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            count = lambda t, p=library: len(p.encode(t, add_special_tokens=False).ids)
        for r in tokencounts.counts(docs, path).where("doc_id IS NOT NULL").collect():
            assert r["n_tokens"] == count(ODD[r["doc_id"]] or "")


def test_token_counts_beyond_the_cache():
    pieces = tokencounts.Pieces(tokencounts.vocabulary(), len, most=3)
    for texts in (["a b c"], ["d e f a"], ["g a"]):
        assert list(map(sum, pieces.of_texts(texts))) == [len(library_ids(t)) for t in texts]
    assert len(pieces.known) <= 3


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 2, 50, 49_000, 1 << 40])
def test_simple8b(n, high):
    draw = np.random.default_rng(n)
    ids = draw.integers(0, high, n).astype(np.uint64)
    if n > 1000:
        ids[100:500] = 0
        ids[::97] = 2**63 + 5
        ids[[7, 8, 9, 10]] = 2**60 - 1, 2**60, 2**53 + 1, 2**64 - 1
    offsets, words, escapes = tokenfiles.encode(ids)
    assert (tokenfiles.decode(offsets, words, escapes, n) == ids).all()
    data = tokenfiles.segment([1, None], [n, 0], ids)
    (doc_ids, lengths, back), = tokenfiles.segments(io.BytesIO(data))
    assert doc_ids == [1, None] and list(lengths) == [n, 0] and (back == ids).all()
    if n:
        with pytest.raises(ValueError):
            list(tokenfiles.segments(io.BytesIO(data[:-1] + bytes([data[-1] ^ 1]))))


def test_token_files(spark, docs):
    got = tokenfiles.digest(docs.repartition(3)).orderBy("start").collect()
    order = [None, 0, 1, 2, 3, 3, *range(4, len(ODD))]  # ids of a hot id or none may span files, by the hash of the text
    assert [r["doc_id"] for r in got] == order
    start = 0
    for r in got:
        ids = np.array([*library_ids("null id" if r["doc_id"] is None else ODD[r["doc_id"]]), 1], dtype="<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokenfiles.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    blocks = [("http://a/x y", b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nbody\n\nhttp://fake 1"), ("dns:a", b"20240101\na. 1 IN A 1.2.3.4\n"), ("http://b", b"")]
    data = gzip.compress(archives.arc_opening(version, "f.arc", "20240101")) + b"".join(gzip.compress(archives.arc_line(version, u, "1.2.3.4", "20240102030405", "text/html", len(b)) + b + b"\n") for u, b in blocks)
    got = list(archives.arc_records(io.BytesIO(data)))
    assert [(f["URL"], f["Archive-date"], b) for f, b in got] == [(u, "20240102030405", b) for u, b in blocks]
    assert archives.http_head(blocks[0][1]) == 33 and archives.named_id(blocks[0][1]) == 7 and archives.http_head(blocks[1][1]) == 0
    with pytest.raises(ValueError):
        list(archives.arc_records(io.BytesIO(gzip.compress(gzip.decompress(data)[:-3]))))
    with pytest.raises(ValueError):
        list(archives.arc_records(io.BytesIO(gzip.compress(gzip.decompress(data) + b"nonsense\n"))))
    assert archives.http_head(b"HTTP/1.0 200 OK\nX: y\n\nbody\r\n\r\n") == 22


def test_arc_to_warc(spark):
    same, other = "x" * 1200, "é" * 600
    rows = [(1, "http://a b\n/x", same), (2, None, same), (None, "", same), (3, "u", None), (4, "v", ""), (5, "v", "short"), (6, "v", "short"), (7, "v", other), (7, "v", other), (8, "w", other)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, date string")
    arcs = archives.write_arc(pages, fresh_path(spark, "arc"))
    warcs = archives.arc_to_warc(spark, arcs, fresh_path(spark, "warc"))
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in archives.read_warc(spark, warcs).collect()}
    assert got == {(1, "revisit", 2, 1200), (2, "response", None, 1200), (None, "revisit", 2, 1200), (3, "response", None, 0), (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 5), (7, "revisit", 8, 1200), (8, "response", None, 1200)}
    assert archives.digest(pages).count() == len(rows) and archives.digest(pages.limit(0)).count() == 0
    records = [h for w in warcs for h, _ in archives.warc_records(files.open_old(w["path"]))]
    ids = {h["warc-record-id"] for h in records if h["warc-type"] == "response"}
    assert all(h["warc-refers-to"] in ids for h in records if h["warc-type"] == "revisit")
    every = [h["warc-record-id"] for h in records]
    assert len(set(every)) == len(every)
    assert {h["warc-target-uri"] for h in records if h["warc-type"] != "warcinfo"} >= {"http://a%20b%0A/x", "urn:page:2", "urn:page:None"}
    assert {h["warc-date"] for h in records if h["warc-type"] != "warcinfo"} == {"2024-01-01T00:00:00Z"} and archives.iso("2024") == "2024-01-01T00:00:00Z"


def test_files_of_a_default_file_system(spark, docs, tmp_path):
    """A path without a scheme belongs to the default file system, here one that is mounted; tasks are told where that really is."""
    conf = spark._jsc.hadoopConfiguration()
    before = {k: conf.get(k) for k in ("fs.defaultFS", "fs.viewfs.mounttable.mine.link./data")}
    conf.set("fs.viewfs.mounttable.mine.link./data", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://mine/")
    try:
        listed = tokenfiles.write(docs, "/data/tokens")
    finally:
        for k, v in before.items():
            conf.set(k, v) if v else conf.unset(k)
    assert listed and {p.name for p in (tmp_path / "tokens").iterdir()} == {r["path"].rsplit("/", 1)[1] for r in listed}
    assert tokenfiles.read(spark, listed, len, "n long").count() == docs.count()


def test_toxicity_against_one_compression_a_window():
    """Features, scores and the fit's own texts: each window compressed by itself, with dictionaries given anew."""
    import zstandard

    draw = random.Random(12)
    words = ["".join(draw.choices("abcdefghijk", k=draw.randint(2, 9))) for _ in range(300)]
    bad = ["zqxvurk", "wyzzqof", "xxqwzyv"]
    text = lambda n, share: " ".join(draw.choice(bad) if draw.random() < share else draw.choice(words) for _ in range(n))
    rows = [(text(draw.randint(5, 80), 0.2), 1) for _ in range(60)] + [(text(draw.randint(5, 80), 0), 0) for _ in range(120)]
    model = toxicity.fit(rows, {0: 1200, 1: 60})

    def length(window, tail):
        content = zstandard.ZstdCompressionDict(model.ordinary + tail, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(6, window_log=16, hash_log=13, chain_log=13, min_match=5, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(zstandard.ZstdCompressor(dict_data=content, compression_params=how).compress(window))

    def slow(t):
        w = t.encode().lower().split()
        front = model.ordinary[-200 : toxicity.FRONT - 200]
        saved = []
        for i in range(0, len(w), toxicity.WINDOW):
            window = front + b" " + b" ".join(w[i : i + toxicity.WINDOW]) + b" "
            saved.append(min(max(length(window, bytes(len(model.toxic))) - length(window, model.toxic), 0), toxicity.STEPS))
        if not saved:
            return np.zeros(toxicity.FEATURES)
        top = sorted([*saved, 0])[-2:]
        flags = [float(v == k) for v in top for k in range(toxicity.STEPS + 1)]
        counts = np.array([saved.count(k) for k in range(1, toxicity.STEPS + 1)])
        return np.array([*top, *flags, *np.log1p(counts), *(counts / len(saved)), np.log1p(len(saved))])

    for t in [text(draw.randint(0, 60), draw.choice([0, 0.1, 0.5])) for _ in range(40)] + ["", "one", "É ü " * 9]:
        assert np.allclose(model.features(t), slow(t)), t
    held = [(text(40, 0.2), 1) for _ in range(40)] + [(text(40, 0), 0) for _ in range(40)]
    right = [(model.score(slow(t)) >= 0.5) == bool(label) for t, label in held]
    assert np.mean(right) > 0.95
    # a score of exactly 0.5 is toxic
    even = toxicity.Model(b"", b"", np.zeros(toxicity.FEATURES), np.ones(toxicity.FEATURES), np.zeros(toxicity.FEATURES + 1))
    assert even.score(even.features("any")) == 0.5
