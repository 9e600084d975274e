"""Golden words of the published stemming rules."""

from brightloom.functions.porter import stem

PORTER = """
caresses caress ponies poni ties tie caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper
feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog
effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
dying die flies fli died die denied deni enjoy enjoy say say apology apolog geologi geolog by by
"""

SNOWBALL = """
consign consign consigned consign consigning consign consignment consign consist consist consisted consist
consistency consist consistent consist consistently consist consisting consist consists consist
consolation consol consolations consol consolatory consolatori console consol consoled consol
consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol
consolingly consol consols consol consonant conson consort consort consorted consort consorting consort
conspicuous conspicu conspicuously conspicu conspiracy conspiraci conspirator conspir conspirators conspir
conspire conspir conspired conspir conspiring conspir constable constabl constables constabl
constance constanc constancy constanc constant constant knack knack knackeries knackeri knacks knack
knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel
kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick
knif knif knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit
knitting knit knives knive knob knob knobs knob knock knock knocked knock knocker knocker knockers knocker
knocking knock knocks knock knopp knopp knot knot knots knot generate generat generates generat
generously generous communication communic arsenal arsenal skies sky dying die news news proceed proceed
herring herring ugly ugli gas gas this this kiwis kiwi cries cri ties tie by by say say cry cri
hopping hop hoping hope luxuriated luxuri disabled disabl falling fall
"""


def pairs(text):
    words = text.split()
    return list(zip(words[::2], words[1::2]))


def differences(spark, text, algorithm):
    df = spark.createDataFrame(pairs(text), "word string, want string")
    got = df.withColumn("got", stem("word", algorithm))
    return [tuple(r) for r in got.where("got <> want").collect()]


def test_porter_words(spark):
    assert differences(spark, PORTER, "porter") == []


def test_english_snowball_words(spark):
    wrong = differences(spark, SNOWBALL, "snowball")
    assert wrong == []


def test_stems_by_word_equal_stems_in_the_row(spark):
    from pyspark.sql import functions as F

    from brightloom.functions.porter import stem_array
    from brightloom.operators import search as Q, words as W

    df = spark.createDataFrame([(1, "Hopping ponies, hopping 2 ponies relational"), (2, None), (3, "The cats' caresses")], "id long, text string")
    for algorithm in ("porter", "snowball"):
        got = sorted((r.id, r.pos, r.term) for r in Q.index_tokens(df, "id", "text", stem=algorithm).collect())
        plain = Q.index_tokens(df, "id", "text").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x.term).alias("w"))
        want = sorted((r.id, i, w) for r in plain.select("id", stem_array("w", algorithm).alias("w")).collect() for i, w in enumerate(r.w))
        assert got == want and got
    assert Q.query_terms(spark, "Hopping ponies", stem="porter") == ["hop", "poni"]
    words = [(r.pos, r.word) for r in W.word_tokens(df.where("id = 3"), "id", "text", "porter").orderBy("pos").collect()]
    assert [w for _, w in words] == ["the", "cat", "caress"]
