import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordmill.functions.stemming import stem, stem_tokens, stem_word

# Sample pairs published with the algorithm, plus its listed exceptions.
PAIRS = dict(
    p.split(":") for p in (
        "consigning:consign consignment:consign consist:consist consisted:consist consistent:consist "
        "consisting:consist consists:consist consolations:consol console:consol consoled:consol consoles:consol "
        "consolidate:consolid consolidated:consolid consoling:consol consolingly:consol consols:consol "
        "consort:consort consorted:consort consorting:consort conspicuous:conspicu conspirator:conspir "
        "conspire:conspir conspired:conspir conspiring:conspir constable:constabl constables:constabl "
        "constance:constanc constant:constant knack:knack knacks:knack knag:knag knave:knave knaves:knave "
        "kneaded:knead kneading:knead knee:knee kneel:kneel kneeling:kneel kneels:kneel knell:knell knelt:knelt "
        "knew:knew knick:knick knif:knif knife:knife knight:knight knights:knight knit:knit knits:knit "
        "knitting:knit knob:knob knobs:knob knock:knock knocked:knock knocker:knocker knocking:knock "
        "knopp:knopp knot:knot knots:knot "
        "consign:consign consigned:consign consistency:consist consistently:consist "
        "consolation:consol consolatory:consolatori consolidating:consolid consonant:conson "
        "conspicuously:conspicu conspiracy:conspiraci conspirators:conspir constancy:constanc "
        "knackeries:knackeri knavish:knavish kneeled:kneel knees:knee knightly:knight "
        "knitted:knit knives:knive knockers:knocker generously:generous generates:generat "
        "communication:communic arsenal:arsenal hopping:hop hoping:hope skies:sky dying:die "
        "cries:cri ties:tie gas:gas this:this gaps:gap kiwis:kiwi luxuriated:luxuri say:say by:by "
        "cry:cri bedded:bed national:nation relational:relat conditional:condit digitizer:digit "
        "feudalism:feudal triplicate:triplic formative:format electrical:electr adjustment:adjust "
        "adoption:adopt controlling:control rate:rate cease:ceas probate:probat inning:inning "
        "proceeds:proceed news:news early:earli singly:singl <DATE>:<DATE> say>:say> x<running:x<run"
    ).split()
)


@pytest.mark.parametrize("word,want", PAIRS.items())
def test_published_pairs(word, want):
    assert stem_word(word) == want


@given(st.text(alphabet="aeiouyblstingdmezr<>", min_size=1, max_size=14))
def test_never_empty(word):
    assert stem_word(word)


def test_arrays_keep_shape(spark):
    rows = [(1, ["running", "the", "running"]), (2, []), (3, None), (4, ["flies", None])]
    df = spark.createDataFrame(rows, "i int, t array<string>").repartition(1)
    out = dict(df.select("i", stem_tokens("t")).collect())
    assert out == {1: ["run", "the", "run"], 2: [], 3: None, 4: ["fli", None]}
    words = spark.createDataFrame([("hopping",), (None,)], "w string")
    assert [r[0] for r in words.select(stem(F.col("w"))).collect()] == ["hop", None]
