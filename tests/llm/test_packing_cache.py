"""The words a packing task keeps."""

import public_tokenizers

from skylattice.llm.packing import token_pieces
from skylattice.llm.tokenfiles import WordIds


def test_small_caches_change_no_id(spark):
    docs = spark.createDataFrame([(k, " ".join(f"Word{k * j % 17}, über{j}." for j in range(40)) if k else None) for k in range(30)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = [sorted(map(tuple, token_pieces(docs, path, 64, **more).collect())) for more in ({}, {"cache_words": 3})]
    assert pieces[0] == pieces[1] and len(pieces[0]) > 30


def test_frequent_words_are_tokenized_once_however_many_rare_ones_pass():
    words, told = WordIds(public_tokenizers.path("word_bpe_49k.json"), 5), []
    encode = words.cache.encode
    words.cache.encode = lambda word: told.append(word) or encode(word)
    texts = [f"often again rare{chr(97 + k % 26) * (1 + k // 26)}" for k in range(100)]
    assert words.ids_bytes(texts) == [WordIds.ids_bytes(words, [t])[0] for t in texts]
    assert told.count(b"often") == told.count(b"again") == 1
    assert len(words.cache) + len(words.cache.before) <= 2 * (5 + 3)
