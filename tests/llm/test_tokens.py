import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm.tokens import Encoder

FILES = {"byte_bpe_50k.json": False, "word_bpe_49k.json": True}
ENCODERS = {(f, escape): Encoder(public_tokenizers.path(f), words, escape) for f, words in FILES.items() for escape in (False, True)}
PLAIN = {(f, escape): Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES for escape in (False, True)}
for (_, escape), t in PLAIN.items():
    if escape:
        t.encode_special_tokens = True  # else the library as it comes

SPECIAL = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "A<|endoftext|>.", "  <|endoftext|> \n", "endoftext|>"])
PIECES = st.text(st.sampled_from(list("ab AB.,'19\n\t\r\x0b\x0c\x1c\x85\xa0 　́éßΣ漢🙂st|<>")), max_size=40) | st.text(max_size=40)


@pytest.mark.parametrize("file", PLAIN, ids=str)
@settings(max_examples=400, deadline=None)
@given(text=PIECES | st.tuples(PIECES, SPECIAL, PIECES).map("".join))
def test_pieces_give_the_ids_of_the_whole_text(file, text):
    texts = [text, "a b", None, "", text + " c\n\nd", " " + text]
    ids, bounds = ENCODERS[file](pa.array(texts), 7)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*PLAIN[file].encode(t or "", add_special_tokens=False).ids, 7]


@pytest.mark.parametrize("file", PLAIN, ids=str)
def test_long_piece_and_special_strings(file):
    text = "x" * 5000 + " <|endoftext|> we're  \n\n done " + "ab " * 300
    ids, _ = ENCODERS[file](pa.array([text]), 7)
    assert ids.tolist() == [*PLAIN[file].encode(text, add_special_tokens=False).ids, 7]


LATIN = [chr(c) for c in range(0x250)]


@pytest.mark.parametrize("file", PLAIN, ids=str)
def test_every_latin_character_and_mark(file):
    texts = [t for c in LATIN for t in (c, f"Ab{c}Cd{c}", f"{c}'s {c}' {c}.,'\"&&& {c}<| a{c}̌, {c}́")]
    ids, bounds = ENCODERS[file](pa.array(texts), 7)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*PLAIN[file].encode(t, add_special_tokens=False).ids, 7]


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from([*LATIN, *" '.,&<|>́̌Σ漢"]), max_size=60))
def test_latin_words_and_marks(text):
    for file in PLAIN:
        ids, _ = ENCODERS[file](pa.array([text]), 7)
        assert ids.tolist() == [*PLAIN[file].encode(text, add_special_tokens=False).ids, 7]


def test_latin_words_are_not_taken_apart_again():
    file = public_tokenizers.path("word_bpe_49k.json")
    encoder, seen = Encoder(file, True), []
    encoder._encode = lambda pieces, plain=encoder._encode: seen.extend(pieces) or plain(pieces)
    text = "The Straße, CAFÉ&&& of straße and Īle ÎLE. don't x1 漢"
    ids, _ = encoder(pa.array([text]), 7)
    assert ids.tolist() == [*PLAIN["word_bpe_49k.json", False].encode(text, add_special_tokens=False).ids, 7]
    assert sorted(seen) == sorted([",", "&&&", ".", "don't", "x1", "漢"])
