from types import SimpleNamespace

import pytest

from rejoinder import session


def fake(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default=None: configured or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_the_configured_one():
    assert session.shared_dir(fake("spark://host:7077", "hdfs://x/c/")) == "hdfs://x/c"
    assert session.scratch_path(fake("yarn", "hdfs://x/c"), "hits").startswith("hdfs://x/c/rejoinder/hits-")


def test_only_a_local_master_may_use_a_folder_of_this_machine():
    with pytest.raises(ValueError):
        session.shared_dir(fake("spark://host:7077"))
    assert session.shared_dir(fake("local[2]")) == session.shared_dir(fake("local[*]"))
