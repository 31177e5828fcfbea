from roomweave.functions import geometry as g
from roomweave.sources import versions


def test_versions(spark, tmp_path):
    folder = f"file://{tmp_path}/t"
    assert versions.latest(spark, folder) is None
    versions.save(spark.range(3), folder)
    second = versions.save(versions.latest(spark, folder).where("id > 0"), folder)
    (tmp_path / "t" / "version=3").mkdir()
    assert second.count() == versions.latest(spark, folder).count() == 2


def test_render_matrices(spark):
    row = spark.range(1)
    vectors = lambda axes: [[round(x, 9) + 0.0 for x in r] for r in row.select(*(g.pack(v).alias(f"v{i}") for i, v in enumerate(axes))).first()]
    assert vectors(g.render_axes(g.lits(0, 0, 1), g.lits(2, 0, 1))) == [[0, -1, 0], [0, 0, -1], [1, 0, 0]]
    assert vectors(g.render_axes(g.lits(0, 0, 0), g.lits(0, 0, 0)))[2] == [0, 0, 1]
    assert vectors(g.camera_matrix(g.lits(0, 0, 0), g.lits(0, 0, 5)))[0] == [1, 0, 0]
    m = row.select(g.pose_matrix(g.lits(0, 0, 1), g.lits(2, 0, 1)).alias("m")).first().m
    assert [r[3] for r in m] == [0, 0, 1, 1] and [r[2] for r in m] == [1, 0, 0, 0]
