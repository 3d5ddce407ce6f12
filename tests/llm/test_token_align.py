"""Token alignment against a direct form with the reference tokenizers."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import token_align as T

SMALL = "/root/testdata/sf0.001/documents.parquet"


def plain_align(texts):
    """Encode with the libraries themselves, pair every overlapping token."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(T.A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=T.B_PATH)
    alphabet = T._byte_alphabet()
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in enumerate(map(b.id_to_piece, range(b.get_piece_size())))]
    docs, counts = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text, num_threads=1) if text else []
        size_a = [len(bytes(alphabet[c] for c in a.id_to_token(i))) for i in ids_a]
        joined = b"".join(bytes_b[i] for i in ids_b)
        if not text or joined != (" " + text).encode() or sum(size_a) != len(joined):
            docs.append(([], [], "", []))
            continue
        ends_a, ends_b = [sum(size_a[:k + 1]) for k in range(len(ids_a))], []
        for i in ids_b:
            ends_b.append((ends_b[-1] if ends_b else 0) + len(bytes_b[i]))
        cuts, groups, at = sorted(set(ends_a) & set(ends_b)), [], 0
        for cut in cuts:
            inside = lambda ids, ends: ",".join(str(i) for i, e in zip(ids, ends) if at < e <= cut)  # noqa: E731,B023
            groups.append(f"{inside(ids_a, ends_a)}|{inside(ids_b, ends_b)}")
            at = cut
        links = [(x, y) for x, ex, sx in zip(ids_a, ends_a, size_a) for y, ey in zip(ids_b, ends_b)
                 if ex - sx < ey and ey - len(bytes_b[y]) < ex]
        counts.update(links)
        docs.append((ids_a, ids_b, ";".join(groups), links))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(len(x), len(y), g.count(";") + 1 if g else 0, len(links), sum(counts[p] == top[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "", g)
            for x, y, g, links in docs]


ODD = [None, "", " ", "a", "  two  spaces\n\ntabs\t", "<|endoftext|> <s> </s> <unk>", "a▁b", "漢字かな", "é́ \x00 x",
       "x" * 3000, "word " * 500, "same text", "same text", "mixed 123 don't!?", "퟿\U0001f600 ok"]


def rows_of(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                              "groups_sha256", "groups")) for r in df.collect()}


@pytest.mark.parametrize("chunk_bytes", [1, 2000, T.CHUNK_BYTES])
def test_odd_texts(spark, chunk_bytes):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id int, text string, chunk string")
    got = rows_of(T.align_documents(docs, chunk_bytes=chunk_bytes, with_groups=True))
    assert got == dict(enumerate(plain_align([t or "" for t in ODD])))
    assert got[0] == got[1] == got[6] == (0, 0, 0, 0, 0, 0, "", "")


def test_table_rows(spark):
    docs = spark.read.parquet(SMALL).filter(F.length("text") < 1500)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    got = rows_of(T.align_documents(docs, chunk_bytes=50_000, with_groups=True))
    assert got == dict(zip(texts, plain_align(texts.values())))


def test_query_columns(spark):
    from fleetpulse.llm.queries import op11_token_align
    df = op11_token_align(spark, "/root/testdata/sf0.001")
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.count() == spark.read.parquet(SMALL).count()


def test_not_utf8_null_ids_repeated_rows_and_an_empty_table(spark):
    bad = spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id, CAST(X'ff41' AS STRING) AS text "
                    "UNION ALL SELECT 7, 'a b' UNION ALL SELECT 7, 'a b'")
    got = sorted(tuple(r) for r in T.align_documents(bad).select(F.coalesce("doc_id", F.lit(-1)), "n_a", "groups_sha256").collect())
    assert got[0] == (-1, 0, "") and got[1] == got[2] and got[1][1] == 2
    assert T.align_documents(bad.limit(0)).count() == 0


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        T.token_bytes_a(b'{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "aa": 2}, "merges": [["a", "b"], ["a", "a"]]}}')


def test_very_long_runs():
    enc = T.Encoders(open(T.A_PATH, "rb").read(), open(T.B_PATH, "rb").read())
    for text in (" " * 300_000, "a" * 300_000, "\n " * 100_000):
        found = enc.encode([text.encode()])
        memo = T.Memo(enc)
        at = memo.add(found)[0]
        assert memo.n_links[at].sum() >= max(len(found[0][0]), len(found[0][1]))
