"""Synthetic catalog and vocabulary files (the load script ships none)."""

import os

DS_HEADER = ("data_source_uuid,org_id,org_set_id,dataset_name,dataset_version,geom_type,geom_spec,"
             "boundary_type,has_attributes,download_method,download_subtype,download_data_standard,"
             "download_filename,download_url,download_auth,documentation_url")

LONG = "L" * 120

DATA_SOURCE_ROWS = [
    # uuid, org, set, name, geom_type, geom_spec, boundary, has_attributes
    (1, "US Census", "TIGER/Line", "Counties 2020", "polygon",
     '"[{""op"": ""rename"", ""columns"": {""a"": ""b, c""}}]\n"', "county", "1"),
    (2, "US Census", "TIGER/Line", "Tracts 2020", "", "", "tract", "1"),
    (3, "US Census", "TIGER/Line", "Blocks", "", None, "", ""),          # blank geom type, NULL has_attributes
    (4, "--EPA--", "__Air  Quality__", "PM2.5 (daily)", "point", None, None, "0"),
    (5, "Météo-France", "Données", "Stations été", "point", None, None, "1"),
    (6, "US Census", "TIGER/Line", "counties-2020", "polygon", None, "county", "1"),  # same slug as 1
    (7, LONG, LONG, LONG, "polygon", None, None, None),                 # table_desc > 255
]


def _csv_field(v):
    if v is None:
        return ""           # unquoted blank -> NULL
    if isinstance(v, str) and v.startswith('"'):
        return v            # already quoted
    s = str(v)
    if s == "":
        return '""'         # quoted empty -> ''
    if any(ch in s for ch in ',"\n'):
        return '"' + s.replace('"', '""') + '"'
    return s


def data_source_csv(path):
    lines = [DS_HEADER]
    for uuid, org, oset, name, gtype, spec, boundary, has_attr in DATA_SOURCE_ROWS:
        has = None if has_attr == "" else has_attr
        fields = [uuid, org, oset, name, "v1", gtype, spec, boundary, has, "file", "zip", "shp",
                  f"f{uuid}.zip", f"https://data.example/{uuid}", None, None]
        lines.append(",".join(_csv_field(f) for f in fields))
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


VS_HEADER = "variable_source_id,geom_dependency_uuid,variable_name,variable_desc,data_source_uuid,attr_spec"
VARIABLE_SOURCE_ROWS = [
    (1, 1, "population", "total population", 1, "{}"),
    (2, None, "households", "households", 1, "{}"),        # NULL dependency -> dropped
    (3, 2, "income", "median income", 1, "{}"),           # dependency on unindexed source (blank geom type)
    (4, 1, "ozone", "ozone ppm", 4, "{}"),                 # source without attributes (0)
    (5, 5, "temperature", "daily mean", 5, "{}"),
    (6, 6, "pm25", "pm2.5", 3, "{}"),                      # has_attributes NULL -> dropped
    (7, 4, "wind", "wind speed", 5, "{}"),
]


def variable_source_csv(path):
    lines = [VS_HEADER] + [",".join(_csv_field(f) for f in r) for r in VARIABLE_SOURCE_ROWS]
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def write(path, text, bom=False):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(("﻿" if bom else "") + text)
    return path


def vocabulary_files(d):
    """The six fragment files, with the traps listed in FIXTURES.md."""
    os.makedirs(d, exist_ok=True)
    files = {
        "vocabulary": write(os.path.join(d, "gis_vocabulary_fragment.csv"),
                            "vocabulary_id,vocabulary_name,vocabulary_reference,vocabulary_version,"
                            "vocabulary_concept_id\n"
                            "GIS,GIS vocabulary,https://example.org,v1,2000000001\n"
                            "SDOH,Social determinants,,v1,2000000002\n"
                            "None,No vocabulary,,,0\n", bom=True),
        "concept_class": write(os.path.join(d, "gis_concept_class_fragment.csv"),
                               "concept_class_id,concept_class_name,concept_class_concept_id\n"
                               "Geometry,Geometry class,2000000010\n"
                               "Attribute,Attribute class,2000000011\n"),
        "domain": write(os.path.join(d, "gis_domain_fragment.csv"),
                        "domain_id,domain_name,domain_concept_id\n"
                        "Place,Place domain,2000000020\n"
                        "Metadata,Metadata,0\n"),
        "concept": write(os.path.join(d, "gis_concept_fragment.csv"),
                         "concept_id,concept_name,domain_id,vocabulary_id,concept_class_id,standard_concept,"
                         "concept_code,valid_start_date,valid_end_date,invalid_reason\n"
                         "2000000100,County," + "Place,GIS,Geometry,S,C1,1970-01-01,2099-12-31,\n"
                         "2000000101," + "N" * 300 + ",Place,GIS,Geometry,,C2,1970-01-01,2099-12-31,\n"
                         "2000000102,\"\",Place,GIS,Geometry,,C3,1970-01-01,2099-12-31,\n"
                         "2000000103,Tract,Place,GIS,Geometry,S,C4,1970-01-01,2099-12-31,D\n"),
        "relationship": write(os.path.join(d, "gis_relationship_fragment.csv"),
                              "relationship_id,relationship_name,is_hierarchical,defines_ancestry,"
                              "reverse_relationship_id,relationship_concept_id\n"
                              "Has geom,Has geometry,0,0,Geom of,2000000200\n"
                              "Geom of,Geometry of,0,0,Has geom,2000000201\n"
                              "Has shape,Has shape,0,0,Geom of,2000000202\n"),
        "concept_relationship": write(os.path.join(d, "gis_concept_relationship_fragment.csv"),
                                      "concept_id_1,concept_id_2,concept_code_1,concept_code_2,vocabulary_id_1,"
                                      "vocabulary_id_2,relationship_id,valid_start_date,valid_end_date,"
                                      "invalid_reason\n"
                                      # minted both sides, reverse missing
                                      "2000000100,2000000103,C1,C4,GIS,GIS,Has geom,1970-01-01,2099-12-31,\n"
                                      # minted first side only, reverse missing
                                      "2000000101,44000,C2,X,GIS,SNOMED,Has geom,1970-01-01,2099-12-31,\n"
                                      # minted first side, reverse already present with first id <= 2e9
                                      "2000000102,45000,C3,Y,GIS,SNOMED,Has geom,1970-01-01,2099-12-31,\n"
                                      "45000,2000000102,Y,C3,SNOMED,GIS,Geom of,1970-01-01,2099-12-31,\n"
                                      # reverse already present with first id > 2e9
                                      "2000000103,2000000100,C4,C1,GIS,GIS,Geom of,1970-01-01,2099-12-31,\n"
                                      # no minted side
                                      "44000,45000,X,Y,SNOMED,SNOMED,Has geom,1970-01-01,2099-12-31,\n"
                                      # label missing from relationship
                                      "2000000100,46000,C1,Z,GIS,SNOMED,Unknown rel,1970-01-01,2099-12-31,\n"
                                      # two labels sharing the reverse 'Geom of', reverse missing
                                      "2000000104,2000000105,C5,C6,GIS,GIS,Has geom,1970-01-01,2099-12-31,\n"
                                      "2000000104,2000000105,C5,C6,GIS,GIS,Has shape,1970-01-01,2099-12-31,\n"),
    }
    return files
