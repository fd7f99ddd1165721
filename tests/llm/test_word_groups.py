import public_tokenizers
from tokenizers import Tokenizer

from riskloom.llm import packing


def test_words_of_many_texts_are_learned_at_once(monkeypatch):
    path = public_tokenizers.path(packing.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    texts = ["", *[f"word{'abc'[i % 3]} own{chr(97 + i % 26)}{i} It's, a  TEXT. {'x' * (i % 9)}" for i in range(200)], "last"]
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]

    def learned(cached):
        coder, calls = packing.WordIds(path, cached), []
        real = coder.learn
        coder.learn = lambda words: calls.append(len(words)) or real(words)
        assert [ids.tolist() for ids in coder.each(t.encode() for t in texts)] == want
        return len(calls)

    assert learned(packing.CACHED_WORDS) == 1
    monkeypatch.setattr(packing, "GROUP_BYTES", 300)
    assert 10 < learned(40) < 100  # words are forgotten between groups, and no id changes


def test_new_words_of_any_kind_are_learned_in_short_texts():
    coder, handed = packing.WordIds(packing.public_tokenizers.path(packing.TOKENIZER), cached=400), []
    whole = coder.tokenizer

    class Noted:
        def encode_batch_fast(self, texts, **options):
            handed.extend(len(t.split()) for t in texts)
            return whole.encode_batch_fast(texts, **options)

    coder.tokenizer = Noted()
    odd = ["it's", "ÉTÉ,", "İx", "Σας", "x1.", "(a", "b)", "--", "İ.", "naïve!?", "日本", "a.b", "ﬁn", "é", " z", "\x1cq", "u v"]
    texts = [" ".join([f"{odd[k % len(odd)]}{'q' * (k % 7)}", *odd, f"Word{chr(65 + k % 26)}{chr(97 + k // 26)},"]) for k in range(600)]
    for text, ids in zip(texts, coder.each(t.encode() for t in texts)):
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert max(handed) <= 200


def test_parts_of_plain_letters_go_straight_to_the_model():
    coder, handed = packing.WordIds(packing.public_tokenizers.path(packing.TOKENIZER)), []
    whole = coder.tokenizer

    class Noted:
        def encode_batch_fast(self, texts, **options):
            handed.extend(w for t in texts for w in t.split())
            return whole.encode_batch_fast(texts, **options)

    coder.tokenizer = Noted()
    text = "The Café's don't DON'T end, endtext. (x) re ve ll s t m d 've ﬁre İx a1b startoftext <|endoftext|> -- .a ,; été Ünd... x.y"
    assert coder(text.encode()).tolist() == [*whole.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert "end" not in handed and "the" not in handed and "café" not in handed and "<|endoftext|>" in handed
