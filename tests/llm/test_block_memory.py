"""What a worker holds while it multiplies one block of the shingle join."""

import tracemalloc

import numpy as np
import pandas as pd

from pricelab.llm import shingle_join as S


def test_a_block_of_usual_size_stays_small():
    rng = np.random.default_rng(1)
    rows, left = [], S.BLOCK_ENTRIES
    for batch in range(10):
        n = left // (10 - batch)
        left -= n
        classes = np.arange(4000, dtype=np.int64) + 4000 * batch
        value = rng.integers(0, S.BLOCK_ENTRIES // 3, n).astype(np.uint64)
        owner = rng.integers(0, len(classes), n).astype(np.uint16)
        arrays = [classes, np.full(4000, 300, np.uint32), value, owner, rng.integers(0, 250, n).astype(np.uint8)]
        rows.append((batch, *(x.tobytes() for x in arrays)))
    block = pd.DataFrame(rows, columns=["block", "cids", "sizes", "value", "owner", "place"])
    tracemalloc.start()
    found = S._multiply(block, np.zeros(0, np.uint64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) and peak < 100e6, peak


def test_the_tokenizers_library_is_loaded_for_the_texts_that_need_it():
    from tokenizers import Tokenizer

    from pricelab.llm.packing import Encoder
    from pricelab.llm.queries import byte_bpe

    plain, other = ["", "two words", "naïve\n\n x"], ["a <|endoftext|> b", "y" * 3000]
    library, encoder = Tokenizer.from_file(byte_bpe()), Encoder(byte_bpe())
    ids = lambda texts: [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert encoder.encode(plain) == ids(plain) and encoder.library is None
    assert encoder.encode(plain + other) == ids(plain + other) and encoder.library is not None
