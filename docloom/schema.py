"""Types of the document tree and of the engine's tables, in DDL: they need no session to be imported."""

from __future__ import annotations

QA = "struct<question:string,answer:string>"
FAQ = f"struct<title:string,QAs:array<{QA}>>"
SEGMENT = f"struct<subheading:string,text:string,files:string,contacts:string,faqs:{FAQ}>"
BLOCK = f"struct<heading:string,segments:array<{SEGMENT}>>"
PAGE = f"struct<url:string,title:string,blocks:array<{BLOCK}>>"
TREE = f"base_url string, pages array<{PAGE}>"
TOPICS = "name string, path array<string>, url string, subtopics array<string>, instructions string"
METRICS = "topic string, pages long, faqs long, files long, chars long"
CHUNKS = "struct<max_characters:int,new_after_n_chars:int,overlap:int>"
UPLOAD_STATE = f"name string, file_id string, sha256 string, chunk_params {CHUNKS}, uploaded_at string"
KNOWLEDGE = "id long, topic string, content string"
NODES = (
    "array<struct<pos:int,end_pos:int,depth:int,parent_pos:int,kind:string,tag:string,text:string,href:string,hidden:boolean,in_accordion:boolean,"
    "question:string,answer:string,pairs:array<struct<day:string,times:string>>>>"
)
ELEMENTS = "array<struct<pos:int,end_pos:int,parent_pos:int,tag:string,classes:array<string>,href:string>>"
EXTRACTS = (
    "struct<title:string,questions:array<string>,qa_groups:array<struct<heading:string,qas:array<" + QA + ">>>,phones:array<struct<label:string,phone:string,key:string>>,"
    "hours:string,file_groups:array<struct<heading:string,files:array<string>>>,sections:array<struct<heading:string,text:string>>,error:string>"
)
ERRORS = "array<struct<page_ord:int,url:string,stage:string,error:string>>"
