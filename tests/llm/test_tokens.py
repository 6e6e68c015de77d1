"""Ids of many texts at once."""

import pyarrow as pa
from tokenizers import Tokenizer, models, pre_tokenizers

from factweave.llm import _tokens, op01_packing


def test_pieces_reach_the_tokenizer_together_and_are_kept():
    path = op01_packing.default_tokenizer()
    kept = _tokens.encoder(path, 1)
    whole, made = kept._whole, []

    class Counted:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                out = getattr(whole, name)(*args, **kwargs)
                made.append(len(out))
                return out

            return call

    kept._whole = Counted()
    rows = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}ßé日́" for i in range(5000)), "", None, "  two  \n\n lines\t x 12½", "<| endoftext|>, 😀😀 a'b"]
    for _ in range(2):
        ids, bounds = _tokens.encoder(path, 1).encode(pa.array(rows))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole.encode(r or "", add_special_tokens=False).ids for r in rows]
    # Some ten thousand different pieces, but an encoding for 2,000 of them, and none again.
    assert len(kept._keys) > 5000 and sum(made) < 20
    assert _tokens.encoder(path, 2) is not kept


def test_a_tokenizer_that_is_not_byte_level_gets_piece_after_piece(tmp_path):
    made = Tokenizer(models.WordLevel({"?": 0, "ab": 1, "é": 2, ",": 3}, unk_token="?"))
    made.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "words.json")
    made.save(path)
    rows = ["ab é zz,ab", "é", None, "zzz ab"]
    ids, bounds = _tokens.Encoder(path).encode(pa.array(rows))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[1, 2, 0, 3, 1], [2], [], [0, 1]]
