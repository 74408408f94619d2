"""Each stage against brute force on its own input."""

import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from topic_tables.llm import langid, mixing, pii, simhash
from topic_tables.llm.text import fold

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_equal_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["langid", "simhash", "pii", "mixing", "bpe"]
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns

    one = stage["langid"](spark, docs, SF)
    path = public_tokenizers.path("piece_bpe_32k.model")
    pred = langid.predict(docs, langid.fit(docs, path, fold("doc_id", 4) != 2), path).collect()
    good = {r["doc_id"] for r in pred if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert one.columns == columns and rows_of(one) == rows_of(docs.where(docs.doc_id.isin(list(good))))
    assert len(good) >= 0.99 * docs.count()

    two = stage["simhash"](spark, one, SF)
    near = simhash.near_duplicates(one).collect()
    least = {r["component_id"] for r in near}
    assert two.columns == columns and rows_of(two) == rows_of(one.where(one.doc_id.isin(list(least))))

    three = stage["pii"](spark, two, SF)
    model = pii.fit(two)
    before = two.collect()
    want = []
    for r, spans in zip(before, pii.select([r["text"] for r in before], model)):
        text = pii.redact(r["text"], spans)
        want.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    assert three.columns == columns and rows_of(three) == sorted(want, key=str)
    assert not any("@mail" in t for _, t, *_ in want)

    four = stage["mixing"](spark, three, SF)
    plan = {r["doc_id"]: r for r in mixing.mix(three).documents.collect()}
    got = defaultdict(list)
    for r in four.collect():
        got[r["doc_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    want = {}
    for r in three.collect():
        ends, p = [m.end() for m in WORD.finditer(r["text"])], plan[r["doc_id"]]
        full, rest = divmod(p["taken"], p["size"]) if p["size"] else (0, 0)
        if p["taken"]:
            want[r["doc_id"]] = sorted([r["text"]] * full + [r["text"][:ends[rest - 1]]] * (rest > 0))
    assert four.columns == columns and {k: sorted(v) for k, v in got.items()} == want

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = Counter(tuple(r) for r in stage["bpe"](spark, four, SF).collect())
    want = Counter()
    for r in four.collect():
        ids = tok.encode(r["text"], add_special_tokens=False).ids
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert last == want


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `a.b` int, c0 string, score double, lang_pred string, words int"


def odd_rows():
    base = " ".join(f"the of and thing{i}" for i in range(80))
    rows = [(1, base, "en", "a"), (2, base.replace("thing7 ", "other "), "en", "b"), (2, base.replace("thing7 ", "other "), "en", "b"), (None, base, "en", None),
            (3, None, "en", "a"), (4, "", None, "a"), (5, "123 !!", "en", "b"), (6, "the mail x@y.com and +1 (555) 010-9999 of the thing", "en", "b"),
            (7, "der die das und ist nicht", "de", None), (7, "la casa de los que no es", "es", "c"), (7, "la casa de los que no es", "es", "c"),
            (8, "the word " * 20_000, "en", "c"), (None, "the other thing is of and to a null", "en", "c")]
    return [(*r, len(r[1] or ""), 1, "x", 0.5, "zz", 3) for r in rows]


def test_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = rows_of(out)
        assert rows, name
        if name == "simhash":
            texts = Counter(r["text"] for r in out.collect())
            groups = simhash.near_duplicates(docs).select("root").distinct().count()
            assert all(n == 1 for n in texts.values()) and len(texts) == groups < len(odd_rows())
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_partial_takes_keep_the_text_as_it_stands(spark):
    text = " \n Aa\tb \n\n  c d\x0b e f " * 40
    docs = spark.createDataFrame([(1, text, "s"), (2, "x " * 3, "t")], "doc_id bigint, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).documents.collect()}
    got = [r["text"] for r in mixing.mixed(docs).where("doc_id = 1").collect()]
    full, rest = divmod(taken[1], 240)
    ends = [m.end() for m in WORD.finditer(text)]
    assert rest and sorted(got) == sorted([text] * full + [text[:ends[rest - 1]]])


def test_repeated_rows_share_what_they_take(spark):
    rows = [(1, "a b c d e f", "s")] * 5 + [(2, "g h", "t"), (3, None, "u"), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = sum(r["taken"] for r in mixing.mix(docs).documents.collect())
    assert sum(len(WORD.findall(r["text"])) for r in mixing.mixed(docs).collect()) == plan
