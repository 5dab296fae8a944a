"""BibTeX as APA references: hand-written entries, generated nesting, malformed texts."""

import random

import pytest
from pyspark.sql import functions as F

from cartulary.functions import bibtex
from cartulary.functions.bibtex import apa, name_of, people, plain

CASES = {
    "@article{k1, title={A {B}ig {Title}.}, author={Doe, Jane Q and van der Berg, Jan and {The {Group} and Others}}, journal={J. Tests}, volume=42, number={3}, pages={435--442}, year={2022}, doi={10.1/x_y}}": "Doe, J. Q., van der Berg, J., & The Group and Others (2022). A Big Title. J. Tests, 42(3), 435–442. https://doi.org/10.1/x_y",
    '@string{jt = "J. " # {Tests}} @string(y="20") @Article(k2, author = "M{\\"u}ller-L{\\"u}denscheidt, Jean-Paul", title = "One " # {two} # " three", journal = jt # " A", year = y # 21, month = mar,)': "Müller-Lüdenscheidt, J.-P. (2021). One two three. J. Tests A.",
    "@misc{k3, title={No author \\& no year}, url={https://a.b/c}} trailing": "(n.d.). No author & no year. https://a.b/c",
    "comment @comment{x @y} @book{k4, editor={Jos\\'e Garc\\'{\\i}a and Anders {\\AA}ngstr{\\\"o}m and others}, title={T}, publisher={P}, year=1999, doi={https://doi.org/10.2/z}}": "García, J., Ångström, A., et al. (1999). T. P. https://doi.org/10.2/z",
    "@inproceedings{k5,author={Ludwig van Beethoven and King, Jr, Martin Luther},title={X---Y},booktitle={Proc~Z},pages={1-9},year={n}}": "van Beethoven, L., & King, M. L., Jr (n). X—Y. Proc Z, 1–9.",
}


@pytest.mark.parametrize("text", CASES)
def test_references(text):
    assert bibtex.told_of(text)["apa"] == CASES[text]


@pytest.mark.parametrize("text", ["@article{k, title={A}", "@article{k, title={A}}}} @", "@article{, title={A}}", "@article{k title={A}}", "@article{k, title=nostring}", "@article{k, title={A} year=2}", '@article{k, title="A}', "@article", "no entry", "@a{x,y={1}} @a{z,y={2}}", "@article{k, =3}"])
def test_malformed(text):
    told = bibtex.told_of(text)
    if text.startswith("@article{k, title={A}}}} @"):
        assert told["apa"] == "" and "kind of entry" in told["error"]
    else:
        assert told["apa"] == "" and told["error"]


def test_names():
    assert name_of("de la Cruz, Maria") == ("de la Cruz", ["Maria"], "") and name_of("Maria de la Cruz") == ("de la Cruz", ["Maria"], "")
    assert name_of("{Big Corp, Inc.}") == ("Big Corp, Inc.", [], "") and name_of("Plato") == ("Plato", [], "")
    many = " and ".join(f"L{k}, F" for k in range(25))
    assert people(many) == ", ".join(f"L{k}, F." for k in range(19)) + ", ... L24, F."
    assert people(" and ".join(f"L{k}, F" for k in range(20))).endswith("L18, F., & L19, F.")


def test_accents():
    for tex, want in {r"\'e\`{a}\^o\~n\"{u}\=a\.z": "éàôñüāż", r"\v{s}\c c\H{o}\u g\k{a}\r{a}\d{h}\b{b}": "šçőğąåḥḇ", r"\ss{}x \o \O\l{} {\ae}{\OE} \'{\i}\'\i": "ßx øØł æŒ íí", r"\% \$ \# \_ \{ \} \&": "% $ # _ { } &", r"{\em word} \textbf{b}": "word b"}.items():
        assert plain(tex) == want


@pytest.mark.parametrize("seed", range(5))
def test_nested_braces(seed):
    """Whatever nests, the fields come back."""
    r = random.Random(seed)

    def nested(depth):
        return "".join(r.choice(["a", " ", ",", "=", "#", '"', "@", "1"]) if depth == 0 or r.random() < 0.6 else "{" + nested(depth - 1) + "}" for _ in range(r.randint(0, 6)))

    for _ in range(100):
        fields = {f"f{k}": nested(3) for k in range(4)}
        text = "@misc{key" + "".join(f", {k} = {{{v}}}" for k, v in fields.items()) + r.choice(["", ",", " ,\n"]) + "}"
        found = bibtex.Reader(text).entries()
        assert [(e.kind, e.key, e.fields) for e in found] == [("misc", "key", fields)]
        assert isinstance(apa(found[0]), str)


def test_column(spark):
    rows = [(k, t) for k, t in enumerate([*CASES, None, " ", "@bad{"])]
    got = {r.k: r.r for r in spark.createDataFrame(rows, "k int, t string").repartition(3).select("k", bibtex.reference(F.col("t")).alias("r")).collect()}
    assert [got[k].apa for k in range(len(CASES))] == list(CASES.values()) and got[0].key == "k1" and got[1].kind == "article"
    assert got[len(CASES)] is None and got[len(CASES) + 1] is None and got[len(CASES) + 2].error
