import hashlib

import numpy as np
import tokenizers

from catalogflow.llm import pair_bpe
from tests.llm.conftest import ODD_ROWS, strange_texts


def test_ids_and_texts_equal_the_library(vocabulary, sample):
    path = vocabulary("byte_bpe_50k.json")
    library, own = tokenizers.Tokenizer.from_file(path), pair_bpe.encoder(path)
    texts = strange_texts() + [r.text for r in sample.limit(60).collect()]
    for text, ids in zip(texts, own.encode_texts(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_round_trip_and_digests(vocabulary, odd, empty):
    path = vocabulary("byte_bpe_50k.json")
    found = pair_bpe.encode(odd, path).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in found) == sorted(
        (i or 0, t or "") for i, t in ODD_ROWS
    )
    by_id = {r.doc_id: r for r in pair_bpe.digests(odd, path).collect()}
    for r in found:
        data = np.array(r.ids, "<u4").tobytes()
        assert by_id[r.doc_id].ids_sha256 == hashlib.sha256(data).hexdigest()
        assert by_id[r.doc_id].n_tokens == len(r.ids)
    assert by_id[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert pair_bpe.digests(empty, path).count() == 0
