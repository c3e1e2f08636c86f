import pytest

from corvane import lineage
from corvane.sources import files


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lines_paragraphs_chapters_whole(spark, tmp_path):
    path = write(tmp_path, "book.txt", "one\ntwo\n\nthree\n\n\n\nfour CHAPTER five")
    assert [r.text for r in files.read_lines(spark, path).collect()][:3] == ["one", "two", ""]
    assert sorted(r.text for r in files.read_paragraphs(spark, path).collect()) == ["four CHAPTER five", "one\ntwo", "three"]
    assert [r.text for r in files.read_chapters(spark, path).collect()][1] == " five"
    assert files.read_whole(spark, path).count() == 1


def test_csv_with_quotes_and_index(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, None)], "_c0 int, body string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert files.without_index(back).columns == ["index", "body"]
    assert files.without_index(back, drop=True).columns == ["body"]
    assert [r.body for r in files.head(back, "_c0", n=1).collect()] == ['say "hi", twice']


def test_csv_files_with_columns_in_another_order(spark, tmp_path):
    folder = tmp_path / "mixed order"
    folder.mkdir()
    write(folder, "a.csv", "id,dob,zip\n1,1991,x\n")
    write(folder, "b.csv", 'zip,id,dob\n"y, z",2,1992\n')
    wanted = "id int, zip string"
    schema = spark.createDataFrame([], wanted).schema
    got = files.read_csv(spark, str(folder), schema, mixed=True)
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (2, "y, z")]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(folder), schema).collect()


class Settings:
    """A session that only knows what the folder lookup asks for."""

    def __init__(self, named=None, current=None, master="spark://host:7077"):
        self.conf, self.sparkContext = {"spark.checkpoint.dir": named} if named else {}, self
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def test_the_shared_folder_is_the_named_one():
    assert lineage.shared_folder(Settings("hdfs://x/c", "other")) == "hdfs://x/c"
    assert lineage.shared_folder(Settings(current="hdfs://x/d")) == "hdfs://x/d"
    with pytest.raises(RuntimeError):
        lineage.shared_folder(Settings())
    assert lineage.shared_folder(Settings(master="local[2]")).startswith("/tmp/run-")


def test_tables_are_read_back(spark):
    assert lineage.cut(spark.range(3), "t").count() == 3
    growing = lineage.GrowingTable(spark, "g", spark.range(1).schema)
    growing.append(spark.range(2))
    assert growing.append(spark.range(5, 6)).count() == 1
    assert sorted(r.id for r in growing.read().collect()) == [0, 1, 5]


def test_writing_twice_is_refused(spark, tmp_path):
    files.write_csv(spark.range(1), str(tmp_path / "x"))
    with pytest.raises(Exception):
        files.write_csv(spark.range(1), str(tmp_path / "x"))


def test_shuffle_files_go_with_the_write_and_the_setting_comes_back(spark):
    before = spark.conf.get(lineage.FREED, "false")
    with lineage.freed_shuffles(spark):
        with lineage.freed_shuffles(spark):
            assert spark.conf.get(lineage.FREED) == "true"
        assert spark.conf.get(lineage.FREED) == "true"
    assert spark.conf.get(lineage.FREED, "false") == before
