import random

import public_tokenizers
import pytest

from railyard.llm import pieces, sentence_pieces

sentencepiece = pytest.importorskip("sentencepiece")
model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")


@pytest.fixture(scope="module")
def loaded():
    return pieces.Pieces.load()


def test_trie_holds_every_piece(loaded):
    for i, spelled in enumerate(loaded.spelling):
        if not spelled or i in loaded.byte_ids:
            continue
        state = 0
        for b in spelled:
            at = loaded.base[state] + b + 1
            assert loaded.check[at] == state
            state = at
        assert loaded.value[state] == i


def test_as_the_library_segments():
    """The library, told that the vocabulary is a unigram model, takes the same paths; it adds up in single precision,
    so the lowest scores are raised to where its sums are exact."""
    model = model_pb2.ModelProto()
    model.ParseFromString(open(public_tokenizers.path(pieces.VOCABULARY), "rb").read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.type == 1:
            p.score = max(p.score, -40000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    encoder = sentence_pieces.Encoder(pieces.from_model(library))
    r = random.Random(5)
    bits = ["a", "the", "ing", " ", "  ", "    ", "\n", "é", "́", "日本", "🙂", "ö", "ß", "%%%", "|", "1", " zebra", "\t", "."]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(18))) for _ in range(3000)]
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == library.encode(texts)
    assert [sentence_pieces.decode(encoder.pieces, x) for x in got] == texts


def test_best_path_against_all_segmentations(loaded):
    index = {s: i for i, s in enumerate(loaded.spelling) if s and i not in loaded.byte_ids}

    def score(word):
        best = [0.0] + [None] * len(word)
        for j in range(1, len(word) + 1):
            best[j] = max((best[i] + loaded.scores[index[word[i:j]]] for i in range(j) if best[i] is not None and word[i:j] in index),
                          default=None)
        return best[-1]

    for word in (b" station", b" tionheretion", b"abc", b" x", b" connected"):
        _, m = next(pieces.by_length([word]))
        path = [i for i in pieces.best_path(loaded, m)[0].tolist() if i >= 0]
        assert b"".join(loaded.spelling[i] for i in path) == word and sum(loaded.scores[path]) == score(word)


def test_odd_rows(make_docs, odd_rows):
    rows = sentence_pieces.encode_documents(make_docs(odd_rows + [(90, "a▁b \x00 \U0001F642 ünï", "en", "a")])).collect()
    assert len(rows) == len(odd_rows) + 1 and all(r.round_trip for r in rows)
    assert all(r.n_tokens == len(r.ids) and (r.n_tokens > 0) == (r.doc_id not in (5, 6)) for r in rows)


def test_bounded_cache_changes_nothing(loaded, words, monkeypatch):
    from railyard.llm import sentence_pieces
    texts = [" ".join(words[k:k + 30]) + " é🙂" for k in range(0, 360, 10)]
    free = [x.tolist() for x in sentence_pieces.Encoder(loaded).encode(texts)]
    monkeypatch.setattr(sentence_pieces, "CACHE_BYTES", 3000)
    tight = sentence_pieces.Encoder(loaded)
    assert [tight.encode([t])[0].tolist() for t in texts] == free and tight.held <= 30 * 230


def test_decoding_odd_ids(loaded):
    assert sentence_pieces.decode(loaded, []) == "" and sentence_pieces.decode(loaded, [None, -1, 10**9]) == ""
    assert sentence_pieces.decode(loaded, [int(loaded.byte_ids[0xC3]), int(loaded.byte_ids[0xA9])]) == "é"


def test_empty_table(make_docs):
    assert sentence_pieces.encode_documents(make_docs([])).collect() == []
