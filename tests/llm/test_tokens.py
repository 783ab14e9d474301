import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm.tokens import certain_cuts, default_path, encode, fragments, token_counts, token_ids

PATH = default_path()


def whole():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


TOKENIZER = whole()
ALPHABET = st.text(alphabet=st.one_of(st.sampled_from(list(" \t\n\r 　 '’’sdtmrelv.,!?-_0123456789abzQZ")), st.characters(blacklist_categories=("Cs",))), max_size=120)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_fragments_encode_to_the_ids_of_the_whole(text):
    assert b"".join(fragments(text, PATH)).decode() == text
    assert encode(text, PATH) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_short_texts_are_cut_as_well():
    assert len(fragments("Water is shut off in May.", PATH)) > 4


def test_cuts_never_stand_inside_a_token():
    from cadastra.llm.tokens import _vocabulary

    cut = certain_cuts(PATH)
    assert cut.any() and not any(cut[a, b] for t in _vocabulary(PATH) for a, b in zip(t, t[1:]))


def test_documents(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["don't", "l'été", "公园", "x" * 40, "12,5"]) for _ in range(20000))
    rows = [(1, "Hello  world"), (2, None), (3, ""), (4, "   "), (5, long), (5, long), (None, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.ids) for r in token_ids(df).collect())
    want = sorted(((d is None, d or 0), TOKENIZER.encode(t or "", add_special_tokens=False).ids) for d, t in rows)
    assert got == want
    assert sorted(r.n_tokens for r in token_counts(df).collect()) == sorted(len(ids) for _, ids in want)
    assert token_ids(df.limit(0)).count() == 0
