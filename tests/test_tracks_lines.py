"""UCSC tables: any white space separates fields, and numbers count every line."""

from strandline.operators import tracks as trk


def test_white_space_and_line_numbers(spark):
    fields = ["585", "100", "1", "2", "3", "chr1", "10", "20", "-5", "+", "L1M", "LINE", "L1", "1", "2", "3", "9"]
    lines = ["#bin swScore", "\t".join(fields), "", "  " + "  ".join(fields) + " \t"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, line_no long")
    got = trk.repeat_gff(df).orderBy("attributes").collect()
    assert [r.attributes.split(";")[0] for r in got] == ["ID=rmsk_2", "ID=rmsk_4"]
    assert {tuple(r)[:8] for r in got} == {("chr1", "RepeatMasker", "LINE", 11, 20, "100", "+", ".")}
