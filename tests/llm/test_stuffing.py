import random

import pytest

from cadastra.llm.stuffing import _pages, listed_phrases, stuffed_pages, stuffing_scores

COLS = "doc_id long, text string, url string"
GOODS = ["granite monuments", "pool service", "kayak rental", "dental clinic", "roof replacement", "dog park", "burial plots", "memory care"]
PROSE = ["The board of the association met in the fire hall and the minutes were approved.", "Water is shut off from April until the last frost has passed.", "A plan of correction was received and accepted by the state office.", "We were told that the work would be finished before May; it was not."]


def corpus():
    rng = random.Random(6)
    rows, spam = [], set()
    for i in range(240):
        host = f"https://h{i % 40}.example/p/{i}"
        if i % 6 == 0:
            a, b = rng.sample(GOODS, 2)
            kind = i // 6 % 5
            if kind == 0:
                t = " | ".join(f"{rng.choice(['cheap', 'best', 'buy', ''])} {rng.choice([a, b])}".strip() for _ in range(40))
            elif kind == 1:
                t = "\n".join(f"http://x{rng.randrange(999)}.example/?id={rng.randrange(99)}" for _ in range(15))
            elif kind == 2:
                t = " ".join([rng.choice([a, b]) for _ in range(60)])
            elif kind == 3:
                t = " ".join(f"Looking for {a}? Our {a} are the top rated {a}. Buy {a}, compare {a}, find {a}, get the best {a} online." for _ in range(4))
            else:
                t = rng.choice(PROSE) + "\n\nTags: " + ", ".join(f"{rng.choice([a, b])} {rng.choice(['near me', 'cheap', 'sale', 'online'])}" for _ in range(40))
            spam.add(i)
        elif i % 6 == 1:
            t = "Directory of offices\n" + "\n".join(f"Name{rng.randrange(99)} Person{rng.randrange(99)} - {rng.randrange(9999)} Mill Rd, tel. 555-{rng.randrange(9999):04}" for _ in range(12))
        elif i % 6 == 2:
            t = " ".join([rng.choice(PROSE)] * 9)
        else:
            t = " ".join(rng.choice(PROSE) for _ in range(8)) + rng.choice(["", "\nTags: dog park, pool service", "\nRelated: https://a.example/, https://b.example/"])
        rows.append((i, t, host if i % 11 else None))
    rows += [(1000, None, None), (1001, "", None), (1002, "  \n", None), (1003, "dog park", None), (1004, "word " * 30000, "x"), (1005, "😀", "https://e.example/")]
    return rows, spam


def test_spam_of_every_layout_and_nothing_else(spark):
    rows, spam = corpus()
    df = spark.createDataFrame(rows, COLS).withColumnRenamed("text", "text")
    assert {r.doc for r in stuffed_pages(df).collect()} - {1004} == spam


def test_scores_have_one_row_per_text(spark):
    rows, _ = corpus()
    got = stuffing_scores(spark.createDataFrame(rows, COLS)).collect()
    assert sorted(r.doc for r in got) == sorted(i for i, t, _ in rows if t and t.strip())
    assert all(0 <= r.share <= 1 for r in got)


def test_empty_table(spark):
    assert stuffed_pages(spark.createDataFrame([], COLS)).count() == 0


def test_a_word_repeated_on_one_host_is_a_case(spark):
    rows, spam = corpus()
    assert {r.doc for r in stuffed_pages(spark.createDataFrame(rows, COLS)).collect()} == spam | {1004}


WORLDS = {
    "en": (["copper kettle", "willow basket", "glass marble", "canvas tent", "brass lamp", "cedar chest"], PROSE),
    "de": (["kupferner Kessel", "bunte Murmel", "grosser Weidenkorb", "alte Lampe", "neues Zelt"], [
        "Der Vorstand trat in der Halle zusammen, und das Protokoll wurde ohne Einwand angenommen.", "Das Wasser bleibt abgestellt, bis der letzte Frost vorbei ist.",
        "Ein Plan wurde dem Amt vorgelegt und von ihm im Mai gebilligt.", "Man sagte uns, dass die Arbeit vor dem Winter fertig werde, aber so kam es nicht."]),
}


@pytest.mark.parametrize("lang", list(WORLDS))
@pytest.mark.parametrize("lookup_rows", [1000, 0])
def test_keyword_lists_are_found_without_any_word_known(spark, lang, lookup_rows):
    goods, prose = WORLDS[lang]
    rng = random.Random(3)
    rows = []
    for i in range(240):
        if i % 6 == 0:
            t = [", ", " | ", "\n", " "][i // 6 % 4].join(rng.choice(goods[j % 2 :]) for j in range(40))
        else:
            t = " ".join(rng.choice(prose) for _ in range(8))
        rows.append((i, t, f"https://h{i % 37}.example/{i}"))
    got = {r.doc for r in stuffed_pages(spark.createDataFrame(rows, COLS), lookup_rows=lookup_rows).collect()}
    assert got == set(range(0, 240, 6))


def test_prose_alone_has_no_case(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(PROSE) for _ in range(12)), f"https://h{i % 9}.example/{i}") for i in range(60)]
    assert stuffed_pages(spark.createDataFrame(rows, COLS)).count() == 0


def test_phrases_count_by_distinct_hosts_that_list_them(spark):
    listing = "brass lamp, cedar chest, brass lamp, canvas tent, canvas tent, brass lamp, canvas tent, cedar chest, brass lamp"
    rows = [(i, listing, f"https://h{i % 2}.example/{i}") for i in range(6)]
    assert listed_phrases(_pages(spark.createDataFrame(rows, COLS), "doc_id", "text", "url")).count() == 0
    rows += [(9, listing, "https://h9.example/")]
    assert listed_phrases(_pages(spark.createDataFrame(rows, COLS), "doc_id", "text", "url")).count() >= 2


def test_repeated_sentences_list_nothing(spark):
    rows = [(i, " ".join(PROSE * 5), f"https://h{i}.example/") for i in range(5)]
    assert listed_phrases(_pages(spark.createDataFrame(rows, COLS), "doc_id", "text", "url")).count() == 0


def test_extra_columns_and_repeated_rows(spark):
    rows = [(1, "words of a page that is read by people", "https://a.example/")] * 3
    df = spark.createDataFrame(rows, COLS).selectExpr("*", "1 AS row", "'x' AS host", "2 AS words", "3 AS value")
    assert stuffing_scores(df).count() == 3
