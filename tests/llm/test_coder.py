"""The id coder on real texts: smaller than plain forms, blocks that decode alone, damage that is told."""

import io
import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import id_coder, textscan, token_files
from tallyhouse.llm.registry import tokenizer_path

SF_DIR = os.environ.get("TALLYHOUSE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def ids():
    texts = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["text"]).column(0).combine_chunks()
    with open(tokenizer_path(), encoding="utf-8") as f:
        return token_files.Pieces(f.read(), special_as_text=False).encode(*textscan.text_buffer(texts))[0][:400_000]


def test_smaller_than_order_zero_and_zlib(ids):
    packed = id_coder.pack(ids)
    shares = np.bincount(ids)[np.bincount(ids) > 0] / len(ids)
    order0 = -(shares * np.log2(shares)).sum() * len(ids) / 8
    assert len(packed) < 0.95 * order0
    assert len(packed) < 0.95 * len(zlib.compress(ids.astype("<u2").tobytes(), 6))
    assert (id_coder.read_segment(io.BytesIO(packed)) == ids).all()


def test_a_block_decodes_alone(ids):
    table = ids[: 5 * 512].astype(np.uint16).reshape(5, 512)
    lengths = np.array([512, 512, 512, 512, 300])
    prior = id_coder._Prior.of(table, lengths)
    blocks = id_coder.encode_blocks(table, lengths, prior)
    again = id_coder._Prior.from_bytes(prior.to_bytes())
    for k, n in enumerate(lengths.tolist()):
        assert id_coder.decode_blocks([blocks[k]], np.array([n]), again)[0].tolist() == table[k, :n].tolist()


def test_prior_comes_back_whole(ids):
    prior = id_coder._Prior.of(ids[None, :].astype(np.uint16), np.array([len(ids)]))
    again = id_coder._Prior.from_bytes(prior.to_bytes())
    for name in ("low", "high", "keys", "escapes", "sums", "base", "listed"):
        assert (getattr(prior, name) == getattr(again, name)).all(), name
    assert len(prior.keys) > 100


def test_counts_of_one_byte():
    counts = np.concatenate([np.arange(100_000), 2 ** np.arange(17, 30)])
    told = id_coder._counts(id_coder._rounded(counts))
    assert (told <= counts).all() and (told * 9 >= counts * 8).all() and (told[:16] == np.arange(16)).all()


def test_a_damaged_prior_is_told(ids):
    packed = bytearray(id_coder.pack(ids[:5000]))
    packed[24 + 12 * 3 + 20] ^= 1
    with pytest.raises(ValueError):
        id_coder.read_segment(io.BytesIO(bytes(packed)))
