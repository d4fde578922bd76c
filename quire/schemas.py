"""Explicit schemas of the documents, tables and files that the package reads and writes."""

from pyspark.sql import types as T

IMAGE = "struct<src:string,alt:string>"
PARAGRAPHS_TYPE = T.ArrayType(
    T.StructType()
    .add("classes", T.ArrayType(T.StringType()))
    .add("text", T.StringType())
    .add("images", T.ArrayType(T.StructType().add("src", T.StringType()).add("alt", T.StringType())))
)
#: Ordered paragraph records of books.
RECORDS = f"book_id string, ord long, classes array<string>, text string, images array<{IMAGE}>"
BLOCK = "struct<type:string,id:string,display_text:string,src:string,alt:string,needs_alt_review:boolean>"
METADATA = (
    "struct<title:string,author:string,translator:string,language:string,subject:string,description:string,"
    "source:struct<publisher:string,date:string,isbn:string,url:string,edition:string,rights:string>,production:struct<producer:string,generator:string>>"
)
BOOK = f"metadata {METADATA}, sections array<struct<id:string,type:string,number:int,title:string,subtitle:string,blocks:array<{BLOCK}>>>"
UNIT = "struct<id:string,type:string,display_text:string,tts_text:string>"
MANIFEST = f"metadata {METADATA}, sections array<struct<id:string,type:string,number:int,title:string,subtitle:string,units:array<{UNIT}>>>"
TIMING = "section_id string, audio string, duration_ms long, units array<struct<id:string,type:string,clip_begin_ms:long,clip_end_ms:long,duration_ms:long>>"
ELEMENTS = "path string, ord long, parent long, tag string, attrs map<string,string>, text string"
VIOLATION = "rule string, key string, detail string"
