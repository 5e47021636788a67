"""From an XML dump to map labels, and a rerun on top."""

import json

from atlaslex import jobs
from atlaslex.plans.coord_queries import title_is
from atlaslex.sources import dump, tables
from atlaslex.staging import new_location, stage_root

PAGE = """<page><title>{title}</title><ns>0</ns><id>{id}</id><revision><id>9</id>
<text bytes="5" xml:space="preserve">{text}</text></revision></page>
"""


def write_dump(path, pages):
    path.mkdir()
    body = "".join(PAGE.format(id=i, title=t, text=x) for i, t, x in pages)
    (path / "xxwiki-20200101-pages-articles-multistream.xml").write_text(f"<mediawiki>{body}</mediawiki>", encoding="utf-8")


def article(i):
    place = f"{{{{Coord|{i % 80}|N|{i % 170}|E|type:city|display=inline,title}}}}"
    return (i, f"Town {i}", f"{place} river river mill{i % 7} &lt;ref&gt;note&lt;/ref&gt; ♞ harbour [[Category:Towns|{i}]]")


def test_dump_reader_keeps_text(spark, tmp_path):
    write_dump(tmp_path / "d", [(1, "A", " two  spaces \n&amp;lt; é "), (2, "B", "")])
    first, second = dump.read_dump(spark, str(tmp_path / "d")).orderBy("page_id").collect()
    assert (first.title, first.wikitext) == ("A", " two  spaces \n&lt; é ")
    assert (first.language, first.dump_date) == ("xx", "20200101")
    assert second.wikitext == ""


def test_all_stages(spark, tmp_path):
    folder, source = str(tmp_path / "map"), tmp_path / "dump"
    write_dump(source, [article(i) for i in range(1, 31)] + [(99, "No place", "river"), (98, "Inline", "{{coord|1|2|display=inline}} river")])
    (tmp_path / "words.txt").write_text("river\nharbour\nmill1\nmill2\n")
    (tmp_path / "symbols.txt").write_text("♞♛*\n", encoding="utf-8")

    jobs.index(spark, folder, str(source))
    jobs.index(spark, folder, str(source))
    places = tables.read_stage(spark, f"{folder}/places")
    assert places.count() == 31
    assert tables.read_stage(spark, f"{folder}/titles").count() == 30
    seattle = title_is(places, "Town 12").first()
    assert (seattle.lat, seattle.lon, seattle.type) == (12.0, 12.0, "city")

    jobs.words(spark, folder)
    frequencies = {r.word: r.df for r in tables.read_stage(spark, f"{folder}/doc_freq").collect()}
    assert frequencies["river"] == 30 and frequencies["mill1"] == 5 and "note" not in frequencies
    jobs.place_words(spark, folder)
    jobs.cluster(spark, folder, str(tmp_path / "words.txt"), counts=(4, 8))
    clustered = tables.read_stage(spark, f"{folder}/clusters")
    assert {r.word for r in clustered.select("word").distinct().collect()} == {"river", "harbour", "mill1", "mill2"}

    jobs.label(spark, folder, zooms=("7", "4", "8"))
    labels = tables.read_stage(spark, f"{folder}/labels").collect()
    assert {r.zoom for r in labels} == {"7", "4", "8"}
    assert {r.label for r in labels} <= {"River", "Harbour", "Mill1", "Mill2"}
    back = spark.read.options(header="true").csv(f"{folder}/labels_csv")
    assert back.columns == ["label", "lat", "lon", "zoom"] and back.count() == len(labels)

    jobs.find_symbols(spark, folder, str(tmp_path / "symbols.txt"))
    listed = tables.read_symbol_pages(spark, f"{folder}/symbols_to_page").collect()
    assert [(r.symbol, r.pages) for r in listed] == [("♞", list(range(1, 31)))]
    record = json.loads(spark.read.text(f"{folder}/symbol_places").first()[0])
    assert record == {"title": "♞", "coordsDecimal": {"lat": 1.0, "lon": 1.0}, "page_name": "Town 1"}

    jobs.profile_keywords(spark, folder)
    usage = {r.keyword: r.uses for r in tables.read_stage(spark, f"{folder}/keywords").collect()}
    assert usage == {"type": 30, "display": 31}


def test_word_file_keeps_odd_words(spark, tmp_path):
    from atlaslex.sinks.files import write_word_file

    rows = [("nan", 1, 'Say "hi", it\nsays', 11, 0.5), ("null", 2, "B", -1, -2.0)]
    df = spark.createDataFrame(rows, tables.SIGNIFICANT_WORDS)
    write_word_file(df, str(tmp_path / "w"))
    assert sorted(tuple(r) for r in tables.read_word_file(spark, str(tmp_path / "w")).collect()) == sorted(rows)


def test_stage_folder_is_shared_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert new_location(spark, "x").startswith(configured or stage_root(spark))
    assert new_location(spark, "x") != new_location(spark, "x")


def test_malformed_and_repeated_pages(spark, tmp_path):
    folder, source = str(tmp_path / "map"), tmp_path / "dump"
    first = (5, "Twice", "{{Coord|9|2|display=inline,title}}")
    second = (5, "Twice again", "{{Coord|1|2|display=inline,title}}")
    write_dump(source, [first, article(6), second, (7, "Bad & title", "{{Coord|1|2}}"), (8, "Plain", "text")])
    for _ in range(2):
        jobs.index(spark, folder, str(source))
        rows = {(r.page_id, r.title, r.lat) for r in tables.read_stage(spark, f"{folder}/places").collect()}
        assert rows == {(5, "Twice", 9.0), (6, "Town 6", 6.0)}
        rejected = tables.read_stage(spark, f"{folder}/rejected").collect()
        assert len(rejected) == 1 and "Bad & title" in rejected[0].record
        statistics = tables.read_stage(spark, f"{folder}/statistics").first()
        assert (statistics.pages, statistics.coord_pages, statistics.successes, statistics.rejected) == (5, 4, 3, 1)


def test_dump_in_many_splits_plain_and_bzip2(spark, tmp_path):
    import bz2

    pages = [article(i) for i in range(1, 400)]
    write_dump(tmp_path / "plain", pages)
    (tmp_path / "packed").mkdir()
    raw = next((tmp_path / "plain").iterdir()).read_bytes()
    (tmp_path / "packed" / "xxwiki-20200101.xml.bz2").write_bytes(bz2.compress(raw, 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        for kind in ("plain", "packed"):
            read = dump.read_dump(spark, str(tmp_path / kind))
            assert sorted(r.page_id for r in read.collect()) == list(range(1, 400))
            ordered = read.orderBy("dump_file", "dump_position").collect()
            assert [r.page_id for r in ordered] == list(range(1, 400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_link_jobs_and_questions(spark, tmp_path):
    folder, source = str(tmp_path / "map"), tmp_path / "dump"
    write_dump(source, [article(i) for i in range(1, 6)] + [(9, "Else", "[[de:Anders]] [[Category:Other|x]]")])
    jobs.index(spark, folder, str(source))
    jobs.link_pages(spark, folder, str(source))
    lists = {r.category: (r.pagecount, r.pages) for r in tables.read_stage(spark, f"{folder}/categories").collect()}
    assert lists == {"Towns": (5, [1, 2, 3, 4, 5]), "Other": (1, [9])}
    assert [tuple(r) for r in tables.read_stage(spark, f"{folder}/language_links").collect()] == [(9, "de", "Anders")]
    jobs.ask(spark, folder, "select count(*) as n from {coords} where lat > 2")
    assert tables.read_stage(spark, f"{folder}/answer").first().n == 3
