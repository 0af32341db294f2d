"""The shared work folder, with and without the setting."""

from types import SimpleNamespace

import pytest

from linkweft.plans.session import shared_dir, work_dir


def session(folder, master):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    context = SimpleNamespace(master=master, applicationId=f"{master}-{folder}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_setting_names_the_folder():
    assert shared_dir(session("hdfs:///work/", "yarn")) == "hdfs:///work"
    assert work_dir(session("hdfs:///work", "yarn"), "x").startswith("hdfs:///work/linkweft/x-")


def test_a_local_session_without_setting_gets_one_folder():
    local = session(None, "local[4]")
    assert shared_dir(local) == shared_dir(local)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_setting_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, master))
