import posixpath
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from quillstone.functions import paths


def column(spark, values, expression):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "p string").select(expression(F.col("p"))).collect()]


def test_globs(spark):
    names = ["a/b/c.png", "c.png", "a/c.png", "a/b/c.pngx", "a/b.png", "", "a/b/cc.png"]
    assert column(spark, names, lambda p: paths.matches(p, ["**/c.png"])) == [True, True, True, False, False, False, False]
    assert column(spark, names, lambda p: paths.matches(p, ["a/*.png"])) == [False, False, True, False, True, False, False]
    assert column(spark, names, lambda p: paths.matches(p, ["a/?/c?.png"])) == [False] * 6 + [True]
    assert column(spark, names, lambda p: paths.matches(p, [])) == [False] * 5 + [True, False]
    assert column(spark, names, lambda p: paths.selects(p, ["**"], ["**/c.png"])) == [False, False, False, True, True, True, True]


@pytest.mark.parametrize("bad", ["a[b]", "{a,b}", "!x"])
def test_unsupported_globs(bad):
    with pytest.raises(paths.GlobError):
        paths.glob_regex([bad])


def test_normalised_as_posix(spark):
    names = ["a/./b", "a/../b", "../x", "a/../../x", "/a/..", "a//b/", "", "./", "/../a", "a/b/../../.."]
    assert column(spark, names, paths.normalised) == [posixpath.normpath(n) for n in names]


def test_names(spark):
    names = ["a/b.tar.gz", "noext", "d/.hidden", "x.y"]
    assert column(spark, names, lambda p: paths.stem(paths.basename(p))) == ["b.tar", "noext", "", "x"]
    assert column(spark, names, lambda p: paths.extension(paths.basename(p))) == ["gz", "", "hidden", "y"]
    assert column(spark, names, paths.dirname) == ["a", "", "d", ""]


def test_destination(spark):
    names = ["up/a.png", "other/a.png", "/x"]
    assert column(spark, names, lambda p: paths.destination(p, F.lit("up/"), F.lit("/to/"))) == ["to/a.png", "to/other/a.png", "to//x"]


def test_unquoted(spark):
    names = ["a%20b", "a+b", "plain", "%E2%82%AC", "100%"]
    assert column(spark, names, paths.unquoted) == [unquote(n) for n in names]
