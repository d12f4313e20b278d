from tests.test_entry import counts


def test_a_missing_module_leaves_the_core_and_a_warning():
    n, known, operators, warned = counts("xxhash")
    assert int(n) >= 70 and (known, operators, warned) == ("True", "0", "True")
