"""Settings that answers depend on, the shared folder, and the declared tables."""
import types

import pytest

from strata import schemas as S
from strata import session


class Context:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = "file:" + path


class Conf(dict):
    def set(self, k, v):
        if k not in self.fixed:
            self[k] = v

    fixed = ()


def fake(master, checkpoint=None, **conf):
    return types.SimpleNamespace(sparkContext=Context(master, checkpoint), conf=Conf(conf))


def test_a_cluster_must_name_the_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
        assert session.shared_dir(fake(master, "hdfs://shared/x")) == "hdfs://shared/x"
        assert session.shared_dir(fake(master, **{"spark.checkpoint.dir": "/shared"})) == "file:/shared"
    assert "strata-ckpt-" in session.shared_dir(fake("local[4]")) and "strata-ckpt-" in session.shared_dir(fake("local"))


def test_settings_that_do_not_hold_raise(monkeypatch):
    monkeypatch.setattr(session, "ship_package", lambda s: None)
    session.apply_conf(fake("local"))
    stubborn = fake("local", **{"spark.sql.ansi.enabled": "false"})
    stubborn.conf.fixed = ("spark.sql.ansi.enabled",)
    with pytest.raises(RuntimeError, match="ansi"):
        session.apply_conf(stubborn)


def test_tables_can_be_declared_in_a_catalog(spark, tmp_lake):
    try:
        S.create_tables(spark, location=tmp_lake)
        S.create_tables(spark, location=tmp_lake)               # again: no error
        for t in S.ALL_TABLES:
            cols = {f.name: f for f in spark.table(t.qualified).schema.fields}
            assert list(cols) == t.names
        spark.sql("INSERT INTO ref.tmx_tags VALUES (1, 'Race')")
        with pytest.raises(Exception):
            spark.sql(f"INSERT INTO ref.tmx_tags VALUES (2, '{'x' * 51}')")
        assert spark.table("ref.tmx_tags").count() == 1
    finally:
        for layer in {t.layer for t in S.ALL_TABLES}:
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
