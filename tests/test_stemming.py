import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import stemming

# Word lists of the published algorithm, step by step, after all steps.
PUBLISHED = """
caresses caress ponies poni ties tie caress caress cats cat feed feed agreed agre
plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl
sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail
filing file happy happi relational relat conditional condit rational ration
valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam
predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal
electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac
adjustment adjust dependent depend adoption adopt homologou homolog
communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll
""".split()
# Extensions: irregular forms, short words, y after a vowel, four-letter -ies / -ied.
EXTENDED = "skies sky dying die news news by by is is enjoy enjoy dies die died die spied spi".split()


@pytest.mark.parametrize("pairs", [PUBLISHED, EXTENDED])
def test_word_lists(pairs):
    wrong = {
        word: (stemming.porter(word), stem)
        for word, stem in zip(pairs[::2], pairs[1::2])
        if stemming.porter(word) != stem
    }
    assert not wrong


def test_lists_with_nulls_and_slices():
    lists = pa.array([["cats"], None, [], ["running", "cats"], ["ponies"]])
    assert stemming._stem_lists(lists.slice(1)).to_pylist() == [None, [], ["run", "cat"], ["poni"]]


def test_column_and_vocabulary_agree(spark):
    frame = spark.createDataFrame([(["cats", "ran"],), (None,), (["cats"],)], "w array<string>")
    stems = [r[0] for r in frame.select(stemming.stem_words(F.col("w"))).collect()]
    assert stems == [["cat", "ran"], None, ["cat"]]
    terms = frame.select(F.explode("w").alias("term"))
    assert dict(stemming.stem_vocabulary(terms).collect()) == {"cats": "cat", "ran": "ran"}
