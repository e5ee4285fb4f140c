"""What a worker keeps from one operator's tasks is let go when another's begin."""
import public_tokenizers as P

from intake_spark.llm import held, langid, piece_codec


def test_a_worker_holds_one_operators_tables():
    model = P.path("piece_bpe_32k.model")
    held.begin("piece_codec")
    first = piece_codec.codec(model)
    held.begin("piece_codec")
    assert piece_codec.codec(model) is first
    held.begin("langid")
    assert piece_codec.codec.cache_info().currsize == 0
    langid._PARTS["folder", "part"] = ()
    held.begin("langid")
    assert langid._PARTS
    held.begin("weighted_minhash")
    assert not langid._PARTS
