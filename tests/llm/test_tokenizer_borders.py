import pytest


def test_a_tokenizer_whose_tokens_hold_the_space_is_refused(spark):
    import public_tokenizers

    from gridloom.llm.packing import pack_documents, require_borders

    require_borders(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="white space"):
        pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
