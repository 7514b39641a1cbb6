"""Attributes of page elements are read one by one; what stands in a value is no attribute."""

import pytest

from parcelwing.llm import wrappers


@pytest.mark.parametrize("attributes, other", [
    ("style='overflow:hidden'", False), ("data-state='hidden'", False), ("title='hidden class=menu'", False),
    ("data-class=menu", False), ('title="a" data-x="id=\'sidebar\'"', False), ("hidden", True), ("HIDDEN=''", True),
    ("aria-hidden='true'", True), ("aria-hidden='false'", False), ("Class = menu", True), ("id='a'class='sidebar'", True),
    ("role=navigation", True)])
def test_marks(attributes, other):
    (block,) = wrappers.parse(f"<body><div {attributes}><p>story</p></div></body>")
    assert block[1] == other and block[3] == "story"
