"""Toxicity, PII, token files, byte BPE and the pipeline."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from strata.llm import byte_bpe, crf, surrogates, token_files
from strata.llm.elias_fano import EliasFano
from tests.llm.data import SCHEMA, empty, frame, rows

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------ toxicity

def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    m = crf.Crf(rng.normal(size=crf.BUCKETS), rng.normal(size=(2, 2)), 0.3)
    b = [0, 0, 3, 0, 0, 0, 5, 1, 0, 0]
    n = len(b)
    want = np.zeros(n)
    total = 0.0
    for y in range(1 << n):
        tag = [y >> k & 1 for k in range(n)]
        e = m.first * tag[0] + sum(m.emission[b[k]] for k in range(n) if tag[k])
        e += sum(m.transition[tag[k], tag[k + 1]] for k in range(n - 1))
        total += np.exp(e)
        want += np.exp(e) * np.array(tag)
    want /= total
    for at in ([2, 6, 7], list(range(n)), [0, 2, 6, 7, 9]):
        got = m.marginals(at, [b[k] for k in at], n)
        assert np.allclose(got, want[at])


def test_toxicity_held_out_and_awkward_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = crf.fit(docs, labels)
    got = crf.score(docs, model).join(labels, "doc_id").filter(crf.held_out("doc_id")).select("score", "toxic").toPandas()
    rank = got.score.rank().to_numpy()
    pos = got.toxic.to_numpy() == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.93 and ((got.score >= 0.5) == pos).mean() > 0.97
    text = "ha an idiot idiot moron thing"
    n, at, p = model.tag(text)
    spans = model.offsets(text, at, p)
    assert n == 6 and any(text[s["start"]:s["end"]].startswith("idiot") for s in spans)
    out = crf.score(frame(spark), model, keep=["n", "text", "score"], score_col="toxicity").collect()
    assert len(out) == len(rows()) and all(0 <= r.toxicity <= 1 and r.n == 8 and r.score == 0.9 for r in out)
    assert {r.toxicity for r in out if not (r.text or "").strip()} == {r.toxicity for r in out if r.text == "one two"}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        model = crf.fit(frame(spark), labels)
        assert {r.score for r in crf.score(frame(spark), model).collect()} == {0.0}
    assert crf.score(empty(spark), model).count() == 0
    assert crf.fit(empty(spark), odd).coef is None


# ----------------------------------------------------------------------- PII

def test_surrogates_keep_type_format_and_identity(spark):
    a = ("Mr. John Smith wrote a.b9@mail.example.com, card 4111-1111-1111-1111, ip 10.1.2.3 and 8.8.4.4, "
         "+1 (212) 555-0147, token = \"9233A8ECF7C5B09FE5949719\" GB82 WEST 1234 5698 7654 32 123-45-6789")
    b = "Again John Smith? Mr. John Smith, A.B9@mail.example.com 4111111111111111 +1!! (212)!! 555-0147!! Анна Петрова"
    data = [(1, a), (2, b), (3, a), (4, None), (5, ""), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, 3, 4, 0.9, 5, 6, 7, 8, 9) for i, t in data], SCHEMA)
    got = {r.doc_id: r for r in surrogates.replace_pii(df, b"k", count_col="bumps").collect()}
    assert got[4].text is None and got[5].text == "" and got[1].text == got[3].text == got[None].text
    one, two = got[1].text, got[2].text
    for leak in ("Smith", "mail.example", "4111", "10.1.2.3", "8.8.4.4", "555-0147", "9233A8", "WEST", "123-45"):
        assert leak not in one and leak not in two
    card = re.search(r"card (\d{4}-\d{4}-\d{4}-\d{4}),", one)[1]
    assert surrogates.luhn_ok(card.replace("-", "")) and card.replace("-", "") in two      # coreference
    name = re.search(r"Mr\. (\w+ \w+) wrote", one)[1]
    assert f"Mr. {name}," in two and name.split()[0] in surrogates.GIVEN["latin", "m"]
    assert re.search(r"ip 10\.\d+\.\d+\.\d+ and", one)
    phone = re.search(r"\+1 \((\d{3})\) (\d{3}-\d{4})", one)
    assert f"+1!! ({phone[1]})!! {phone[2]}!!" in two
    assert surrogates.iban_ok(re.search(r"GB\d\d(?: \w{4}){4} \w\w", one)[0].replace(" ", ""))
    assert re.search(r'token = "[0-9A-F]{24}"', one)
    new = re.search(r"!! (\w+) (\w+)$", two)
    assert new[1] in surrogates.GIVEN["cyrillic", "f"] and got[1].bumps == 9 and got[1].n_chars == len(one)


def test_surrogates_stay_distinct(spark):
    """Few surrogates per kind at first: collisions must be resolved."""
    names = [("name", f"m:Name{chr(65 + i // 26)}{chr(97 + i % 26)}") for i in range(400)]
    ips = [("ip", f"172.16.{i // 250}.{i % 250}") for i in range(600)]
    df = spark.createDataFrame(names + ips, "kind string, canon string")
    got = surrogates.resolve(df, b"k").collect()
    assert len(got) == 1000 == len({(r.kind, r.surrogate) for r in got})
    assert not {(r.kind, r.surrogate) for r in got} & {(r.kind, r.canon) for r in got}


def test_surrogates_on_awkward_rows(spark):
    got = surrogates.replace_pii(frame(spark), b"k").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t, *_ in rows())
    assert surrogates.replace_pii(empty(spark), b"k").count() == 0


def test_personal_data_in_common_forms_is_found():
    for got in ("555-123-4567", "212.555.0187", "212 555-0187", "1-800-555-0199", "06 12 34 56 78", "0612345678",
                "020 7946 0958", "07911 123456", "030 1234567", "089/12345678", "212!! 555-0187",
                "2001:db8::8a2e:370:7334", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1",
                "3782 822463 10005", "3782-822463-10005", "John Smith", "Mary Johnson", "John Michael Smith",
                "Sean O'Brien", "Jean-Luc Picard-Dupont", "John F. Kennedy", "Ludwig van der Berg", "Сергей Иванов"):
        text = f"Then we met {got}, today."
        assert [text[s:e] for s, e, _, _ in surrogates.find(text)] == [got]
    for title, got in (("Mr ", "John Michael Smith"), ("Mr. ", "O'Brien"), ("Dr. ", "J. Smith"), ("Mrs ", "Smith-Jones")):
        text = f"Then {title}{got} came. They left."
        assert [text[s:e] for s, e, _, _ in surrogates.find(text)] == [got]
    text = "Mr Andrea Rossi came; Andrea Rossi left."
    assert [c for _, _, _, c in surrogates.find(text)] == ["m:Andrea Rossi"] * 2
    keyed = surrogates.Keyed(b"k")
    assert keyed.canonical("ipv6", "fe80::1").startswith("fe80::") and keyed.canonical("ipv6", "2001:db8::1")[0] in "23"
    assert keyed.canonical("phone", "0612345678")[0] == "0"


def test_clean_text_is_left_alone():
    for text in ("At 12:34:56 and 01:02:03.", "std::vector and a::b", "MAC aa:bb:cc:dd:ee:ff",
                 "aa:bb:cc:dd:ee:ff:00:11:22:33:44:55:66:77:88:99", "ISBN 978-3-16-148410-0", "2024-01-15, 15.01.2024",
                 "12 345 678 units, 1 234 567 890", "1,234,567.89", "order 123-4567890-1234567", "pages 100-2000",
                 "01 02 03 04 05 06 07", "Mary The", "John And then", "Peter Street", "The Mark Of", "It was Paul."):
        assert surrogates.find(text) == []


def test_more_given_names_than_surrogates_settle(spark):
    """Single given names after a title outnumber the pool of given names."""
    names = sorted(n for n, g in surrogates.GENDER.items() if g == "m" and n.isascii())[:120]
    df = spark.createDataFrame([("name", f"m:{n}") for n in names], "kind string, canon string")
    got = {r.surrogate for r in surrogates.resolve(df, b"k").collect()}
    assert len(got) == 120 and not got & {f"m:{n}" for n in names}


# -------------------------------------------------------------------- tokens

def test_elias_fano():
    rng = np.random.default_rng(1)
    for v in ([], [0], [7], [3, 3, 3], list(range(1000)), [0, 10 ** 12], np.sort(rng.integers(0, 10 ** 6, 3000)).tolist()):
        image = EliasFano.of(v).to_bytes()
        e, end = EliasFano.from_bytes(b"xx" + image + b"yy", 2)
        assert end == len(image) + 2 and e.values().tolist() == v and [e.select(i) for i in range(len(v))] == v
    assert len(image) * 8 / 3000 < 13                      # 2 + log2(10**6 / 3000) and the directory
    with pytest.raises(IndexError):
        e.select(3000)


def test_token_files(spark, tmp_path):
    tok = Tokenizer.from_file(WORD_BPE)
    tok.encode_special_tokens = True
    data = rows() + [(900, "<|endoftext|> İstanbul ﬁ \x1c a\x85b é ¼²３ 'S don't", "en", "s", 1, *rows()[0][5:])]
    folder, manifest = token_files.write_token_files(frame(spark, data), WORD_BPE, str(tmp_path / "out"), file_ids=500)
    got = token_files.read_token_files(folder, manifest).collect()
    assert manifest.count() > 4
    ids = {}
    for i, t, *_ in data:
        ids.setdefault((i, t), tok.encode(t or "", add_special_tokens=False).ids + [2])
    at = 0
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, *_ in data), key=lambda i: (i is None, i))
    left = sorted((str(i), v) for (i, t), v in ids.items() for _ in range(sum((i, t) == (a, b) for a, b, *_ in data)))
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == left
    for r in order:
        assert r.start == at and r.n_tokens * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    path = sorted((tmp_path / "out").glob("*.ids"))[0]
    f = token_files.TokenFile(path.read_bytes())
    assert f.document(0).tolist() == np.frombuffer(order[0].ids, "<u4").tolist()
    folder, manifest = token_files.write_token_files(empty(spark), WORD_BPE, str(tmp_path / "none"))
    assert token_files.read_token_files(folder, manifest).count() == 0


def test_token_query_equals_the_library_default(spark, tmp_path):
    """Strings of added tokens in a text, as the library takes them by itself."""
    from strata.llm import queries
    tok = Tokenizer.from_file(WORD_BPE)
    texts = ["a <|endoftext|> b", "x<|startoftext|><|endoftext|>É日本<|endoftext|", "<|ENDOFTEXT|> <|endoftext|>", "plain",
             "<|<|endoftext|>|> ﬁ<|endoftext|>'s", "a\u0301<|endoftext|>\u0301", None]
    data = rows() + [(1000 + k, t, *rows()[0][2:]) for k, t in enumerate(texts)]
    frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_elias_fano_tokens(spark, str(tmp_path)).collect()
    want = [(str(i), tok.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, *_ in data]
    assert want[len(rows())][1] == [320, 49407, 321, 2]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (i, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for i, v in want)


def test_byte_bpe_equals_tiktoken(spark):
    ranks = byte_bpe.read_ranks(BPE)
    tk = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    odd = ["".join(rng.choice("ab 's\n\t\x85\xa0 éЖ中1٣ ²_-.\x1c\x00😀") for _ in range(50)) for _ in range(300)]
    odd += ["a" * 5000, "  x", " \n\n y  ", "don't'S", ""]
    data = rows() + [(1000 + k, t, "en", "s", 1, *rows()[0][5:]) for k, t in enumerate(odd)]
    got = byte_bpe.round_trip(frame(spark, data), BPE, public_tokenizers.PATTERN).collect()

    def want(i, t):
        ids = tk.encode_ordinary(t or "")
        return (str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == \
        sorted(want(i, t) for i, t, *_ in data)
    enc = byte_bpe.encode(frame(spark), BPE, public_tokenizers.PATTERN)
    dec = byte_bpe.decode(enc, BPE, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in dec) == sorted((str(i), (t or "").encode()) for i, t, *_ in rows())
    assert byte_bpe.round_trip(empty(spark), BPE, public_tokenizers.PATTERN).count() == 0


def test_tokens_no_merge_reaches():
    """A pre-token that is a token is that token, merges or not."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bcd": 257}
    import tempfile
    with tempfile.NamedTemporaryFile(suffix=".tiktoken") as f:
        f.write(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
        f.flush()
        c = byte_bpe.Codec(f.name, public_tokenizers.PATTERN)
    tk = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in ("bcd", "abcd", "bcdab", "xbcd"):
        assert c.encode_batch([t])[0].tolist() == tk.encode_ordinary(t)


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        seen[name] = docs
        if name != "tokens":
            assert docs.schema.names == first.schema.names
        if name in ("toxicity", "near_dups"):               # whole rows of the input, unchanged
            assert docs.exceptAll(before).count() == 0
    from tests.llm.test_ngram_join import brute
    tox = [(r.doc_id, r.text) for r in seen["toxicity"].collect()]
    stay = sorted(i for i, _, c in brute(tox) if i == c)
    assert sorted(r.doc_id for r in seen["near_dups"].collect()) == stay
    pii = {r.doc_id: r for r in seen["pii"].collect()}
    assert sorted(pii) == stay and all(r.n_chars == len(r.text) for r in pii.values())
    mixed = seen["mix"].collect()
    tk = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(BPE),
                           special_tokens={})
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in seen["tokens"].collect()) == sorted(
        (r.doc_id, len(tk.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed)


def test_pipeline_on_awkward_rows(spark):
    import corpus_pipeline
    for docs in (frame(spark), empty(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert docs.count() <= 2 * n
        assert n == 0 or docs.count() > 20


def test_registered():
    import __spark_entry__ as E
    names = [q for q in E.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)", q)[1]) for q in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(E.oracle_sql()) <= set(E.queries())


def test_marginals_of_long_gaps():
    """Exact far beyond the listed powers, also where tags mix slowly."""
    import numpy as np

    from strata.llm.crf import Crf
    rng = np.random.default_rng(5)
    for transition, n in ((np.array([[4.0, -4.0], [-4.0, 4.0]]), 300), (rng.normal(size=(2, 2)) * 2, 2000),
                          (np.array([[3.0, -3.0], [-5.0, 5.0]]), 10_000)):
        crf = Crf(np.concatenate([[-0.05], rng.normal(size=8)]), transition, 0.3)
        at = sorted({10, n - 10, *rng.integers(0, n, 4).tolist()})
        bucket = rng.integers(1, 9, len(at)).tolist()
        b = np.zeros(n, int)
        b[at] = bucket
        t, e = np.exp(crf.transition), np.exp(crf.emission)
        factor = np.column_stack([np.ones(n), e[b]])
        forward, backward = np.empty((n, 2)), np.ones((n, 2))
        forward[0] = factor[0] * [1.0, np.exp(crf.first)]
        for k in range(1, n):
            forward[k] = (forward[k - 1] / forward[k - 1].sum()) @ t * factor[k]
        for k in range(n - 2, -1, -1):
            backward[k] = t @ (factor[k + 1] * backward[k + 1])
            backward[k] /= backward[k].sum()
        p = forward * backward
        want = (p[:, 1] / p.sum(1))[at]
        assert np.abs(np.array(crf.marginals(at, bucket, n)) - want).max() < 1e-9
