"""Blocks of pages with unclosed and embedded elements."""

import pytest

from mergewell.llm.blocks import blocks_of


def texts(page):
    return [b.text for b in blocks_of(page)]


@pytest.mark.parametrize("tag", "video audio object canvas svg select noscript template math".split())
def test_an_unclosed_element_drops_no_blocks_after_it(tag):
    page = f"<p>one</p><{tag} class=x><p>two</p>" + f"<div><{tag}>three</div>" * 2
    assert texts(page) == ["one", "two", "three", "three"]


@pytest.mark.parametrize("tag", "script style textarea iframe".split())
def test_raw_text_goes_on_to_its_end_tag(tag):
    assert texts(f"<p>one</p><{tag}><p>no</p></{tag}><p>two</p><{tag}><p>no</p>") == ["one", "two"]


def test_formulas_and_fallback_texts_stay_in_their_paragraph():
    page = ("<p>where <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> holds, "
            "<object data=a.pdf>see the <b>paper</b></object> and <canvas>a drawing</canvas> end</p>")
    assert texts(page) == ["where x=2 holds, see the paper and a drawing end"]
    assert texts("<p>a</p><svg><text>no</text></svg><select><option>no</select><p>b</p>") == ["a", "b"]
