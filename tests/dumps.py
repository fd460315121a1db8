"""Small dumps written for the tests."""

import gzip

ARTISTS = """<artists>
<artist><id>1</id><name>One </name><realname>  </realname><aliases><name id="2">Two</name><name id="9">Gone</name></aliases>
<namevariations><name>O.</name><name>O.</name><name> </name></namevariations><urls><url>http://a</url></urls><members><id>3</id><name id="3">Three</name></members></artist>
<artist><id>2</id><name>Two</name><groups><name id="1">One</name></groups></artist>
<artist><id>3</id><name>Three</name></artist>
<artist><id>0</id><name>Zero</name></artist><artist><id>x</id><name>Bad</name></artist><artist><name>None</name></artist>
</artists>"""
LABELS = """<labels>
<label><id>1</id><name>L1</name><contactinfo>c</contactinfo><sublabels><label id="2">L2</label><label id="7">L7</label></sublabels><urls><url>u</url><url>v</url></urls></label>
<label><id>2</id><name>L2</name><parentLabel id="1">L1</parentLabel></label>
</labels>"""
MASTERS = """<masters>
<master id="1"><main_release>5</main_release><title>M1</title><year>1999</year><artists><artist><id>1</id></artist><artist><id>8</id></artist></artists>
<genres><genre>Rock</genre><genre> Rock </genre></genres><styles><style>Punk</style></styles>
<videos><video src="http://v"><title>t</title><description>d</description></video><video><title>no url</title></video></videos></master>
<master id="2"><title>M2</title><year>0</year></master>
</masters>"""
RELEASES = """<releases>
<release id="1" status="Accepted"><title>R1</title><country>DE</country><released>1999-03-00</released><master_id is_main_release="true">1</master_id>
<artists><artist><id>1</id></artist></artists><extraartists><artist><id>2</id><role>Mix</role></artist><artist><id>2</id><role>Mix</role></artist><artist><id>2</id></artist></extraartists>
<labels><label id="1" catno="SK 026"/><label id="1" catno="SK026"/><label id="1" catno=""/><label id="5" catno="x"/></labels>
<formats><format name="CD" qty="0002" text=""><descriptions><description> LP </description><description>Limited</description></descriptions></format><format qty="1"/></formats>
<genres><genre>Rock</genre><genre>Jazz</genre></genres><styles><style>Punk</style></styles>
<tracklist><track><position>6</position><title>Яд</title></track><track><position>7</position><title>Ад</title></track><track><position/><title/><duration/></track></tracklist>
<identifiers><identifier type="Barcode" value="1"/></identifiers><companies><company><id>2</id><entity_type_name>Made By</entity_type_name></company></companies>
<videos><video src="u"><title>t</title></video></videos></release>
<release id="2"><title>R2</title><released>1992-1x-1c</released><master_id is_main_release="true">77</master_id></release>
<release id="3"><title>R3</title><released>19920405</released><master_id is_main_release="false">2</master_id></release>
</releases>"""


def write(folder, **texts):
    """Paths of gzip dumps by entity."""
    out = {}
    for entity, text in texts.items():
        out[entity] = str(folder / f"d_20260701_{entity}s.xml.gz")
        with gzip.open(out[entity], "wt", encoding="utf-8") as f:
            f.write(text)
    return out


ALL = {"artist": ARTISTS, "label": LABELS, "master": MASTERS, "release": RELEASES}
