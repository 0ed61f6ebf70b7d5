import pytest
from pyspark.sql import functions as F

from reviewlake.operators import language, lemmas, pages


def test_held_out_language_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("lang", "language")
    held_out = F.xxhash64("doc_id") % 4 == 0
    model = language.fit_profiles(docs.where(~held_out))
    found = language.identify(docs.where(held_out), model, "doc_id", name="found")
    score = found.join(docs, "doc_id").agg(F.avg((F.col("found") == F.col("language")).cast("double"))).first()[0]
    assert score > 0.95


def test_texts_without_letters_keep_their_row(spark):
    train = spark.createDataFrame([("the cat", "en"), ("le chat", "fr")], "text string, language string")
    model = language.fit_profiles(train)
    texts = spark.createDataFrame([(1, "the"), (2, ""), (3, "123 !"), (4, None), (5, "le chat")], "id int, text string")
    got = {r["id"]: r["language"] for r in language.identify(texts, model).collect()}
    assert got == {1: "en", 2: "en", 3: "en", 4: "en", 5: "fr"}


@pytest.mark.parametrize("max_bytes", [1 << 28, 0])
def test_sparse_profiles_give_the_same_languages(spark, sf_dir, max_bytes):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("lang", "language")
    texts = docs.unionByName(spark.createDataFrame([(-1, "12 !", None, None, None), (-2, None, None, None, None), (-3, "ʘʘʘʘ", None, None, None)], docs.schema))
    wide = language.identify(texts, language.fit_profiles(docs), "doc_id", name="found")
    sparse = language.identify(texts, language.fit_profiles(docs, wide=1), "doc_id", name="found", max_bytes=max_bytes)
    assert sorted(map(tuple, sparse.collect())) == sorted(map(tuple, wide.collect()))


def test_more_languages_than_columns(spark):
    letters = "abcdefghijklmnop"
    word = lambda i: "".join(letters[i >> shift & 15] for shift in (8, 4, 0)) * 2
    rows = spark.createDataFrame([(i, f"{word(i)} common {word(i)}", f"l{i:04d}") for i in range(1500)], "id int, text string, language string")
    model = language.fit_profiles(rows)
    assert isinstance(model, language.SparseLanguageModel) and model.penalties.count() == 1500
    assert language.profile_table(model).count() == model.profiles.agg(F.sum(F.size("known"))).first()[0]
    found = language.identify(rows, model, name="found").join(rows, "id")
    assert found.where("found <> language").count() == 0 and found.count() == 1500


def test_trigrams_against_brute_force(spark):
    texts = spark.createDataFrame([(1, "Hyvä, ääni 4K!"), (2, "𝒳a b")], "id int, text string")
    got = {}
    for r in language.trigrams(texts, "id", "text").where("gram is not null").collect():
        got.setdefault(r["id"], []).append(r["gram"])
    for key, plain in {1: " hyvä ääni k ", 2: " 𝒳a b "}.items():
        assert sorted(got[key]) == sorted(plain[i : i + 3] for i in range(len(plain) - 2))


def test_keep_takes_a_list(spark):
    rows = spark.createDataFrame([("fi",), ("en",), ("sv",)], "language string")
    assert language.keep(rows, "fi").count() == 1 and language.keep(rows, ["fi", "sv"]).count() == 2


def test_model_hook_ships_the_loader_not_the_model(spark):
    def loader():
        import threading

        class Model:
            lock = threading.Lock()  # cannot be pickled

            def __call__(self, batch):
                return batch.str.upper()

        return Model()

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    got = language.apply_model(rows, loader, "id", "text", "up")
    assert {tuple(r) for r in got.collect()} == {(1, "A"), (2, "B")}


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(
        [("fi", "koirat", 0, "koira", "NOUN"), ("fi", "ettei", 0, "että", "SCONJ"), ("fi", "ettei", 1, "ei", "AUX")],
        "language string, form string, word_idx int, lemma string, upos string",
    )


def test_lemmas(spark, lexicon):
    rows = spark.createDataFrame(
        [(1, "fi", "Koirat, ettei 12 kissa!", "Koirat"), (2, "fi", "... 3,5 7", ""), (3, "en", "koirat + %", None)],
        "id int, language string, text string, title string",
    )
    got = {r["id"]: r for r in lemmas.lemmatise_columns(rows, "id", lexicon).collect()}
    assert got[1]["lemmatized_text"] == "koira että ei kissa"
    assert got[1]["lemmatized"] == "koira koira että ei kissa"
    assert got[2]["lemmatized_text"] == "" and got[2]["lemmatized"] == " "
    assert got[3]["lemmatized_text"] == "koirat +" and got[3]["lemmatized_title"] == ""
    words = lemmas.lemmatise(lemmas.tokenise(rows, "id", "text"), lexicon)
    stats = lemmas.token_stats(words.withColumn("field", F.lit("text"))).first()
    assert (stats["tokens"], stats["vocabulary"]) == (6, 6)
    single = {r["id"]: r["lemmatized_text"] for r in lemmas.lemma_text(words, "id").collect()}
    assert single == {k: v["lemmatized_text"] for k, v in got.items()}


def _exchanges(df):
    """What each exchange of the plan deals out by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_a_big_lexicon_shuffles_no_row_per_token(spark, lexicon):
    """a row per token crossed the network once the lexicon was too big to broadcast."""
    rows = spark.range(60).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'fi' WHEN 1 THEN 'en' END AS language",
        "CASE WHEN id % 7 > 0 THEN concat('Koirat, ettei ', id, ' kissa! ettei 3,5') END AS text", "concat('Ettei ', id % 5) AS title",
    )
    docs = lemmas.placed(rows, "id", ["text"], chunk_bytes=200)
    small, big = (lemmas.words_of(docs, "id", "text", lexicon, max_bytes=b) for b in (1 << 28, 0))
    # the exchanges deal out documents and answers by chunk, and different forms; tokens with their positions never
    assert "FlatMapCoGroupsInArrow" in big._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in _exchanges(big) if "pos#" in x or "hashpartitioning(_chunk" in x and "form" in x]
    found = [sorted(map(str, words.drop("_chunk").select("id", "language", "pos", "token", "form", "word_idx", "lemma", "upos").collect())) for words in (small, big)]
    assert found[0] == found[1] and len(found[0]) > 300
    texts = [sorted(map(str, lemmas.lemmatise_columns(rows, "id", lexicon, max_bytes=b).collect())) for b in (1 << 28, 0)]
    assert texts[0] == texts[1] and len(texts[0]) == 60
    single = [sorted(map(str, lemmas.lemma_text(words, "id").collect())) for words in (small, big)]
    assert single[0] == single[1]


def test_sparse_languages_are_found_without_shuffling_grams(spark):
    """a row per text and gram was shuffled although the profiles may be broadcast."""
    rows = spark.range(40).selectExpr("id", "concat('the cat ', id, ' sat le chat noir') AS text", "CASE id % 2 WHEN 0 THEN 'en' ELSE 'fr' END AS language")
    model = language.fit_profiles(rows, wide=0)
    found = language.identify(rows, model)
    assert not [x for x in _exchanges(found) if "gram#" in x]
    assert sorted(found.collect()) == sorted(language.identify(rows, model, max_bytes=0).collect())


LINE = '<script>x({"id": 1, "reviewText": {"k": 2}});</script>'


def test_embedded_json(spark):
    rows = spark.createDataFrame(
        [
            (0, "<p>{}</p>\n"),
            (1, f"a {{b}}\n{LINE}\nc"),
            (2, f"{LINE}\n{LINE}"),
            (3, None),
            (4, '"reviewText" {a: 1}'),
            (5, '{a: 1} "reviewText"'),
            (6, '} "reviewText" {'),
            (7, f"x\r{LINE} y"),
        ],
        "id int, html string",
    )
    good, rejects = pages.extract_embedded_json(rows)
    found = {r["id"]: r["json"] for r in good.collect()}
    assert found == {1: '{"id": 1, "reviewText": {"k": 2}}', 7: '{"id": 1, "reviewText": {"k": 2}}'}
    assert {r["id"]: r["matches"] for r in rejects.collect()} == {0: 0, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0}


def test_matches_equal_a_plain_regex(spark):
    import random
    import re

    rng = random.Random(4)
    pieces = ["{", "}", '"s"', "x", "\n", " ", '{"s":1}', "\r"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    for r in rows.select("id", pages.json_matches("html", "s").alias("m")).collect():
        assert r["m"] == re.findall(r'{.*"s".*}', texts[r["id"]])


def test_paging_from_the_document(spark):
    text = '{"products": {"reviewsById": {}, "reviewsByPid": {"5": [{"totalItems": 25, "byPage": {"1": ["a","b","c","d","e","f","g","h","i","j"]}}]}}}'
    rows = pages.parse_products(spark.createDataFrame([("http://h/p/#x", text), ("http://h/q/", "broken")], "url string, json string"))
    numbered = pages.paging(rows)
    got = {r["url"]: (r["total"], r["per_page"], r["pages"]) for r in numbered.collect()}
    assert got == {"http://h/p/#x": (25, 10, 3), "http://h/q/": (None, None, None)}
    more = [r["page_url"] for r in pages.further_pages(numbered).collect()]
    assert sorted(more) == ["http://h/p/reviews?page=2", "http://h/p/reviews?page=3"]
