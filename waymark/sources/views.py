"""Domain views over the driver tables, as portable SQL. Braces name the tables or views that a view reads."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

VIEWS: dict[str, str] = {
    "places": """
SELECT CAST(c_custkey AS STRING) AS place_id, c_custkey AS seq, c_nationkey AS nation_id,
  CONCAT('Store ', CAST(c_custkey % 300 AS STRING),
         CASE WHEN CAST(FLOOR(c_custkey / 300.0) AS BIGINT) % 3 = 1 THEN ' B' ELSE '' END) AS name,
  CONCAT('서울 ', CASE c_custkey % 5 WHEN 0 THEN '강남구' WHEN 1 THEN '마포구' WHEN 2 THEN '서초구'
                                    WHEN 3 THEN '강북구' ELSE '송파구' END,
         ' 테헤란로 ', CAST(c_custkey % 300 AS STRING)) AS address,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 37.40 + CAST((c_custkey * 7) % 100 AS DOUBLE) * 0.003
       + CAST(CAST(FLOOR(c_custkey / 300.0) AS BIGINT) % 2 AS DOUBLE) * 0.0008 END AS lat,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 126.80 + CAST((c_custkey * 11) % 150 AS DOUBLE) * 0.0026 END AS lng,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 50 AS DOUBLE) / 10 END AS naver_rating,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST((c_custkey * 3) % 50 AS DOUBLE) / 10 END AS kakao_rating,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey * 13) % 50 AS DOUBLE) / 10 END AS src_rating,
  CASE WHEN c_custkey % 10 < 8 THEN 'open' WHEN c_custkey % 10 = 8 THEN 'suspended' ELSE 'closed' END AS status,
  CASE c_custkey % 6 WHEN 0 THEN NULL
       WHEN 1 THEN CONCAT('07-', LPAD(CAST(c_custkey % 10000 AS STRING), 4, '0'), '-1234')
       WHEN 2 THEN CONCAT('0212', LPAD(CAST(c_custkey % 1000000 AS STRING), 6, '0'))
       WHEN 3 THEN ''
       ELSE CONCAT('02-', LPAD(CAST(c_custkey % 300 AS STRING), 4, '0'), '-5678') END AS phone,
  c_mktsegment AS refill_type, c_custkey % 2 = 0 AS is_confirmed
FROM {customer}""",
    "categories": """
SELECT CAST(0 AS BIGINT) AS id, '고기' AS name UNION ALL SELECT 1, '해산물' UNION ALL SELECT 2, '양식'
UNION ALL SELECT 3, '한식' UNION ALL SELECT 4, '중식' UNION ALL SELECT 5, '일식' UNION ALL SELECT 6, '디저트'""",
    "place_categories": """
SELECT place_id, seq % 6 AS category_id FROM {places} WHERE seq % 13 <> 0
UNION ALL SELECT place_id, (seq + 1) % 6 FROM {places} WHERE seq % 4 = 0 AND seq % 13 <> 0""",
    "price_text": """
SELECT p_partkey AS id, CASE p_partkey % 10 WHEN 0 THEN '1만원' WHEN 1 THEN '10,000원~15,000원'
  WHEN 2 THEN '런치 8천원, 디너 1만2천원'
  WHEN 3 THEN CONCAT('1인 ', CAST(CAST(FLOOR(p_retailprice) AS INT) * 10 AS STRING), '원 (2인 이상)')
  WHEN 4 THEN CONCAT('무한리필 ', CAST(CAST(FLOOR(p_retailprice) AS INT) * 10 AS STRING), '원')
  WHEN 5 THEN '가격 문의' WHEN 6 THEN '2만원대' WHEN 7 THEN '평일 1만8천원, 주말 2만2천원'
  WHEN 8 THEN NULL ELSE '' END AS price_text FROM {part}""",
    "hours_text": """
SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN '영업시간: 11:30 - 23:30 라스트오더: 22:30'
  WHEN 1 THEN '7월 4일(금) 7월 5일(토) 영업시간: 11:00 - 23:00 영업시간: 16:00 - 22:00 브레이크타임 15:00~16:00'
  WHEN 2 THEN '오늘(목) 영업시간: 00:00 - 24:00' WHEN 3 THEN '18:00~02:00 월요일 휴무'
  WHEN 4 THEN '25:10 - 26:70' ELSE NULL END AS hours_text FROM {part}""",
    "hours_lines": """
SELECT id, CASE WHEN id % 17 = 0 THEN NULL WHEN id % 17 = 1 THEN '' ELSE CONCAT(
  CASE id % 4 WHEN 0 THEN '영업 중\n' WHEN 1 THEN '오늘 09:00 - 10:00\n' ELSE '' END,
  SUBSTR('월화수목금토일', CAST(1 + id % 7 AS INT), 1), '요일 ',
  CASE size % 4 WHEN 0 THEN CONCAT('영업시간: ', LPAD(CAST(8 + id % 5 AS STRING), 2, '0'), ':30 - ', CAST(20 + id % 4 AS STRING), ':00')
    WHEN 1 THEN CONCAT('오전 ', CAST(7 + id % 6 AS STRING), '시 ~ 오후 ', CAST(8 + id % 5 AS STRING), '시')
    WHEN 2 THEN CONCAT(CAST(9 + id % 3 AS STRING), '시-', CAST(21 + id % 3 AS STRING), '시') ELSE CONCAT(CAST(9 + id % 3 AS STRING), ':00~', CAST(18 + id % 5 AS STRING), ':30') END, '\n',
  CASE WHEN id % 11 = 0 THEN '' ELSE SUBSTR('월화수목금토일', CAST(1 + (id + size) % 7 AS INT), 1) END, ': ', CASE id % 3 WHEN 0 THEN '휴무' WHEN 1 THEN '11:00-22:00' ELSE '' END, '\n',
  CASE WHEN id % 6 < 2 THEN CONCAT('11:00 ~ 21:', CAST(10 + size % 50 AS STRING), '\n') ELSE '' END,
  CASE id % 5 WHEN 0 THEN CONCAT('휴무일: ', SUBSTR('월화수목금토일', CAST(1 + size % 7 AS INT), 1)) WHEN 1 THEN CONCAT('매주 ', SUBSTR('월화수목금토일', CAST(1 + size % 7 AS INT), 1), '요일 휴무')
    WHEN 2 THEN '7월 5일(토) 12:00 - 20:00' WHEN 3 THEN '화 11:00-22:00' ELSE '' END) END AS lines
FROM (SELECT p_partkey AS id, p_size AS size FROM {part}) p""",
    "menu_json": """
SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN '[]'
  ELSE CONCAT('[{{"name":"', p_name, '","price":"', CAST(p_size * 1000 AS STRING), '원","price_numeric":', CAST(p_size * 1000 AS STRING),
  ',"is_recommended":', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END, '}},{{"name":"","price":"0원"}}]') END AS menu_items FROM {part}""",
    "failures": """
SELECT event_id, ts, user_id, CONCAT('http://h', CAST(user_id % 10 AS STRING), '/p?rid=', CAST(event_id AS STRING)) AS url,
  CASE CAST(FLOOR(value) AS BIGINT) % 5 WHEN 0 THEN 'No such element selector:.a' WHEN 1 THEN 'Connection timeout'
  WHEN 2 THEN '403 Forbidden' WHEN 3 THEN 'rate limit' ELSE 'other' END AS error_message
FROM {events} WHERE event_type = 'error'""",
    "crawl_log": """
SELECT event_id AS id, ts AS created_at, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
  CAST(FLOOR(value) AS BIGINT) AS found, user_id FROM {events}""",
    "reviews": """
SELECT o_orderkey AS review_id, CAST(o_custkey AS STRING) AS place_id, o_orderdate AS created_at,
  CAST(o_orderkey % 50 AS DOUBLE) / 10 AS rating FROM {orders}""",
    "quality_issues": """
SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS STRING) AS place_id,
  CASE l_linenumber % 3 WHEN 0 THEN 'coordinate' WHEN 1 THEN 'duplicate' ELSE 'business_hours' END AS issue_type,
  CASE l_returnflag WHEN 'A' THEN 'low' WHEN 'N' THEN 'medium' ELSE CASE l_linestatus WHEN 'F' THEN 'high' ELSE 'critical' END END AS severity,
  l_linestatus = 'F' AS auto_fixed, l_shipdate AS created_at FROM {lineitem}""",
    "upsert_batch": """
SELECT place_id, seq + k * 100000 AS batch_seq, CASE WHEN k = 0 THEN NULL ELSE CONCAT(address, ' 신관') END AS address,
  CASE WHEN k = 1 THEN NULL ELSE src_rating END AS src_rating, CASE WHEN k = 0 THEN 'open' ELSE 'suspended' END AS status
FROM {places} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) kk WHERE seq % 4 = 0""",
    "raw_categories": """
SELECT place_id, CASE seq % 9 WHEN 0 THEN '#삼겹살 무한리필' WHEN 1 THEN '초밥뷔페' WHEN 2 THEN '강남맛집' WHEN 3 THEN '수제 햄버거'
  WHEN 4 THEN '짜장면' WHEN 5 THEN '카페 디저트' WHEN 6 THEN '할인 파스타' WHEN 7 THEN '' ELSE 'BBQ' END AS raw FROM {places}""",
    "details": """
SELECT p_partkey AS id, p_name AS name,
  CONCAT(CASE p_partkey % 4 WHEN 0 THEN 'Advertisement 메뉴정보  ' WHEN 1 THEN '리뷰 사진 ' WHEN 2 THEN '' ELSE '평점  ' END,
    CASE p_partkey % 3 WHEN 0 THEN '삼겹살  무한리필' WHEN 1 THEN '초밥 뷔페' ELSE '모듬 세트' END) AS raw_menu,
  CONCAT('성인 ', CASE p_partkey % 3 WHEN 0 THEN '고기 무한리필 추천' WHEN 1 THEN '초밥 뷔페' ELSE '샐러드 셀프바' END, ' ', CAST(3 + p_partkey % 60 AS STRING), ',900원\n',
    '안녕하세요 오늘은 후기 리뷰 20,000원\n', CASE WHEN p_partkey % 5 = 0 THEN '콜라 2,000원' ELSE '점심 고기 무한리필' END, ' ',
    CAST(7 + p_partkey % 11 AS STRING), ',000 원\n김\n성인 초밥 뷔페 12,000원') AS section,
  CONCAT('var a = 1; ', CASE p_partkey % 4 WHEN 0 THEN '"latitude": ' WHEN 1 THEN 'poi_lat = ' WHEN 2 THEN 'mapLat: ' ELSE 'x: ' END, '37.', CAST(p_partkey % 90 + 10 AS STRING), ', ',
    CASE p_partkey % 4 WHEN 0 THEN '"longitude": ' WHEN 1 THEN 'poi_lng = ' WHEN 2 THEN 'mapLng: ' ELSE 'y: ' END, CASE WHEN p_partkey % 7 = 0 THEN '99.' ELSE '126.' END, CAST(p_partkey % 80 + 10 AS STRING), ';') AS script,
  CONCAT('aData = [{{"menu":{{"list":[{{"menu":" ', p_type, ' ","price":"', CAST((p_partkey % 130) * 1000 AS STRING), '원"}},{{"menu":"B","price":"8000원"}}]}}}}];') AS menu_script,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '24시간 영업' WHEN 3 THEN '11:00 - 22:00' ELSE '연중무휴' END AS open_hours,
  CASE WHEN p_partkey % 3 = 0 THEN '15:00~16:00' WHEN p_partkey % 3 = 1 THEN '' END AS break_time,
  CASE WHEN p_partkey % 4 = 0 THEN '월요일' END AS holiday,
  CONCAT(CASE p_partkey % 3 WHEN 0 THEN 'https://i/' WHEN 1 THEN '//i/' ELSE 'data:' END, CAST(p_partkey AS STRING), '|http://j/', CAST(p_partkey % 9 AS STRING), '||ftp://k|https://m|https://n|https://o|https://q|https://m') AS image_list,
  CASE p_partkey % 6 WHEN 0 THEN '폐업 안내, 운영중단' WHEN 1 THEN '준비중입니다' WHEN 2 THEN '준비중 오픈 예정' WHEN 3 THEN '리모델링 후 이전' WHEN 4 THEN NULL ELSE '정상 영업' END AS notice
FROM {part}""",
    "list_json": """
SELECT seq AS page_id, name AS keyword, address AS rect_area, CASE WHEN seq % 41 = 0 THEN 'no list' WHEN seq % 43 = 0 THEN '{{}}' ELSE CONCAT('{{"poi_section":{{"list":[{{"v_rid":"', place_id, '","nm":"', CASE WHEN seq % 6 = 0 THEN '' ELSE name END,
  '","branch":"', CASE seq % 3 WHEN 0 THEN '강남점' ELSE '' END, '","addr":"', address, '","road_addr":"', address, ' 1층","phone":"02-', LPAD(CAST(seq % 10000 AS STRING), 4, '0'), '-1234","distance":"', CAST(seq % 90 AS STRING), 'm","category":"고기",',
  CASE WHEN seq % 4 = 0 THEN '' ELSE CONCAT('"lat":37.', CAST(seq % 90 + 10 AS STRING), '1,"lng":126.', CAST(seq % 80 + 10 AS STRING), '1,') END, '"score":', CAST(seq % 100 AS STRING), ',"user_score":', CAST(seq % 5 AS STRING), '.5,',
  CASE WHEN seq % 5 = 0 THEN '' ELSE CONCAT('"review_cnt":', CAST(seq % 70 AS STRING), ',"image_list":["https://i/', place_id, '","https://j/1"],"keyword":["회식","', CAST(seq % 9 AS STRING), '"],') END, '"open_status":"영업 중"}},{{"v_rid":"', place_id,
  'b","nm":"둘째 ', name, '"}},{{"nm":"번호 없음"}}]}}}}') END AS list_data FROM {places}""",
    "list_pages": """
SELECT seq AS page_id, CONCAT('<html><body><div class="List"><a class="PoiBlock New" href="', CASE WHEN seq % 5 = 0 THEN '/x.php?id=1' ELSE CONCAT('/profile.php?k=1&amp;rid=R', place_id, '&amp;z=2') END, '" ',
  CASE seq % 3 WHEN 0 THEN 'data-lat' ELSE 'data-latitude' END, '="', CASE WHEN seq % 6 = 0 THEN 'n/a' ELSE CONCAT('37.', CAST(seq % 90 + 10 AS STRING)) END, '" ', CASE seq % 4 WHEN 0 THEN '' WHEN 1 THEN CONCAT('data-lng="127.', CAST(seq % 8 + 1 AS STRING), '"') ELSE CONCAT('data-longitude="126.', CAST(seq % 80 + 10 AS STRING), '"') END, '>',
  CASE WHEN seq % 7 = 0 THEN '' ELSE CONCAT('<h2>', CASE seq % 4 WHEN 0 THEN '12. ' WHEN 1 THEN '3.' WHEN 2 THEN '7 ' ELSE '' END, name, CASE seq % 3 WHEN 0 THEN '<span class="Info__Title__Place">강남점 </span>' ELSE '' END, '</h2>') END,
  '<p class="Score"><span>', CASE WHEN seq % 8 = 0 THEN '8.5' ELSE CAST(seq % 100 AS STRING) END, '</span></p><span class="score-text">', CASE WHEN seq % 9 = 0 THEN '-' ELSE CONCAT(CAST(seq % 5 AS STRING), '.4') END, '</span><span class="Category">고기</span> <span class="Category"> </span><span class="Category">뷔페 &amp; 회</span></a>',
  '<a class="Other" href="/profile.php?rid=no"><h2>다른 곳</h2></a><a class="PoiBlock" href="/profile.php?rid=S', place_id, '"><h2>', CAST(seq % 30 AS STRING), '. ', address, '</h2></a></div>', CASE WHEN seq % 2 = 0 THEN '</body></html>' ELSE '' END) AS html FROM {places}""",
    "detail_pages": """
SELECT id AS page_id, CONCAT('<!DOCTYPE html><html><head><title>', name, '</title><script>', script, '</script><script type="text/javascript">', menu_script, '</script></head><body><h1>', name, '</h1><!-- <p>메뉴정보</p> -->\n',
  CASE id % 9 WHEN 0 THEN '' WHEN 1 THEN '<div class="menu-box"><p>메뉴정보</p><div>준비중</div></div>' ELSE CONCAT('<div class="menu-box"><p>메뉴정보</p><ul><li><p>', raw_menu, '</p><p>', CAST(5 + id % 30 AS STRING), ',900원</p></li><li><p>공기밥&amp;찌개 추천</p><p>',
    CASE WHEN id % 6 = 0 THEN ',' ELSE CONCAT(CAST(1 + id % 3 AS STRING), ',000') END, ' 원</p></li><li><p>음료</p><p>0원</p></li><li><p>', name, '</p><p>시가</p></li><li><p>', name, '</p></li></ul></div>') END, '\n<ul><li>주차 가능</li>',
  CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN '<li>영업시간: <b>25:10 - 26:70</b></li>' ELSE CONCAT('<li>영업시간: <b>', LPAD(CAST(9 + id % 4 AS STRING), 2, '0'), ':00 - 22:30</b> 라스트오더: 21:', CAST(10 + id % 50 AS STRING), CASE WHEN id % 2 = 0 THEN ' 브레이크타임 15:00~16:00 월요일 휴무' ELSE '' END, '</li><li>휴무 없음</li>') END,
  '</ul>\n<img src="', SPLIT_PART(image_list, '|', 1), '">', CASE WHEN id % 6 = 0 THEN '' ELSE CONCAT('<img alt="a > b" src="', SPLIT_PART(image_list, '|', 2), '"/><img src="https://m">') END,
  '<p class="desc-intro">', COALESCE(notice, ''), CASE WHEN id % 4 = 0 THEN ' 전통 있는 무한리필 고기집' ELSE '' END, '</p><div class="summary">짧다</div>\n<div class="info">', section, '</div>\n',
  CASE WHEN id % 7 = 0 THEN '<a href="/list.dc?query=4">강남구 맛집</a>' ELSE CONCAT('<a href="/list.dc?query=1">서울특별시</a> <a href="/list.dc?query=2">', CASE id % 3 WHEN 0 THEN '강남구' WHEN 1 THEN '마포구' ELSE '서울' END,
    '</a><a href="/list.dc?query=3">강남구 맛집</a><a href="/list.dc?query=2">강남구</a><a href="/list.dc?query=5">', CASE id % 4 WHEN 0 THEN '역삼동' WHEN 1 THEN '테헤란로 12' ELSE '동' END, '</a><a href="/list.dc?query=6">', CAST(1 + id % 300 AS STRING), '번지</a>') END,
  '\n<footer>전화 ', CASE id % 4 WHEN 0 THEN CONCAT('02-', LPAD(CAST(id % 10000 AS STRING), 4, '0'), '-1234') WHEN 1 THEN '없음' WHEN 2 THEN CONCAT('021', LPAD(CAST(id % 10000000 AS STRING), 7, '0')) ELSE '012-345-6789' END,
  ' <a href="https://www.own.example/1">own</a>', CASE WHEN id % 3 = 0 THEN '' ELSE CONCAT('<a href="http://shop', CAST(id % 50 AS STRING), '.example/">web</a>') END, '</footer>', CASE WHEN id % 3 = 0 THEN '' ELSE '</body></html>' END) AS html FROM {details}""",
    "selector_failures": """
SELECT event_id, ts, CASE event_id % 6 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 404 ELSE 200 END AS code, CASE user_id % 5 WHEN 0 THEN 'No such element selector:.PoiBlock' WHEN 1 THEN CONCAT('No such element selector:.Info__Title', CAST(user_id % 3 AS STRING), ' after 3 s')
  WHEN 2 THEN 'no such element selector:#main' WHEN 3 THEN 'Too Many Requests' ELSE 'other' END AS error_message FROM {events} WHERE event_type = 'error'""",
    "script_menus": """
SELECT id, CASE id % 13 WHEN 0 THEN NULL WHEN 1 THEN 'var b = 2;' WHEN 2 THEN 'aData = [{{broken]; x' ELSE CONCAT('var a=1; aData  = [{{"menu":{{"list":[{{"menu":" ', name, ' ","price":"', CAST(3 + id % 120 AS STRING), ',000원","best":', CAST(id % 2 AS STRING), '}},{{"menu":"특선","price":"약 ',
  CAST(4 + id % 9 AS STRING), ',500원~"}},{{"menu":"","price":"9,000원"}},{{"menu":"시가","price":"시가"}},{{"menu":"모듬","price":"12000원"}}]}}}},{{"menu":1}}];') END AS script FROM {details}""",
    "crawled_stores": """
SELECT id, name, CASE WHEN id % 31 = 0 THEN REPEAT('긴 소개 ', 150) WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN CONCAT('소개 ', name) END AS description, CASE id % 4 WHEN 0 THEN '소고기와 삼겹살  무한리필' WHEN 1 THEN '초밥 뷔페' WHEN 2 THEN '' END AS refill_type,
  CASE id % 5 WHEN 0 THEN '2시간' WHEN 1 THEN '' END AS refill_conditions, CASE id % 6 WHEN 0 THEN '조용한' END AS atmosphere, CASE id % 7 WHEN 0 THEN '좋다' END AS review_summary, CASE id % 8 WHEN 0 THEN NULL ELSE '고기|초밥|회|양식|한식|중식' END AS keywords,
  CASE id % 5 WHEN 0 THEN '12,000원' WHEN 1 THEN '' END AS price, CASE id % 7 WHEN 0 THEN ' 평균 13,000원 ' END AS average_price, CASE id % 11 WHEN 0 THEN '1만원대' END AS price_range, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CONCAT('9,000원||', CAST(id % 9 AS STRING), ',500원|1원|2원') END AS price_details,
  CASE id % 6 WHEN 0 THEN 'https://i/1' WHEN 1 THEN '//i/2' WHEN 2 THEN 'data/x.png' WHEN 3 THEN 'ftp://y' WHEN 4 THEN '' END AS main_image, CASE id % 9 WHEN 0 THEN '/local/1.png' WHEN 1 THEN 'x.png' WHEN 2 THEN '' END AS main_image_local,
  CASE id % 5 WHEN 0 THEN NULL ELSE CONCAT('http://b/', CAST(id % 4 AS STRING), '|https://i/1|https://c|https://d|data/q|https://e|https://f') END AS image_urls, CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN ' |' ELSE '고기| 야채 ||밥' END AS refill_items,
  CASE id % 6 WHEN 0 THEN '[]' WHEN 1 THEN 'broken [' WHEN 2 THEN NULL ELSE CONCAT('[{{"name":"', name, '","price":"9,000원","price_numeric":9000,"order":', CAST(id % 5 AS STRING), '}},{{"name":""}},{{"name":"b","is_recommended":true,"type":"x","description":"d","source":"s"}}]') END AS menu_items FROM {details}""",
    "menu_texts": """
SELECT id, CASE WHEN id % 23 = 0 THEN NULL ELSE CONCAT('a ', raw_menu, ' 추천', CASE WHEN id % 2 = 0 THEN '\n' ELSE ' ' END, CAST(5 + id % 50 AS STRING), ',900원\n평일 점심 15시 이전 입장기준 추천 ', CAST(3 + id % 30 AS STRING), ',500 원\n',
  CASE id % 3 WHEN 0 THEN '무한리필 초등할인(4학년) 추천: 16,000원' WHEN 1 THEN '주말 뷔페 할인 - 21,000원' ELSE '방문 후기 무한리필 9,000원' END, '\n', section, '\n셀프바\n', CAST(6 + id % 9 AS STRING), ',000원') END AS t FROM {details}""",
    "hours_rows": """
SELECT p_partkey AS id, CASE p_partkey % 8 WHEN 0 THEN '24시간 영업' WHEN 1 THEN '11:00 - 22:00' WHEN 2 THEN '25:10 - 26:70' WHEN 3 THEN '22:00 - 11:00' WHEN 4 THEN '연중무휴 10:00~20:00' WHEN 5 THEN '18:00 - 02:00, 11:00 - 14:00' WHEN 6 THEN '' END AS open_hours,
  CASE p_size % 5 WHEN 0 THEN '15:00 - 16:00' WHEN 1 THEN '23:00~23:30' WHEN 2 THEN '' WHEN 3 THEN '없음' END AS break_time, CASE p_size % 3 WHEN 0 THEN '21:30' WHEN 1 THEN ' ' END AS last_order FROM {part}""",
    "checked_places": """
SELECT place_id, name, status, CASE seq % 8 WHEN 0 THEN '02-000' WHEN 1 THEN '1234567890' WHEN 2 THEN NULL WHEN 3 THEN '' WHEN 4 THEN '1111111111' ELSE CONCAT('02-', LPAD(CAST(seq % 300 AS STRING), 4, '0'), '-5678') END AS phone,
  CASE seq % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE CONCAT('http://s', place_id, '.example') END AS website, CASE seq % 6 WHEN 0 THEN 404 WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE 200 END AS site_status,
  CASE seq % 10 WHEN 0 THEN '폐업 안내: 문을 닫았습니다' WHEN 1 THEN '준비중입니다' WHEN 2 THEN '준비중 오픈 예정' WHEN 3 THEN '리모델링 공사중 준비중' WHEN 4 THEN NULL WHEN 5 THEN '확장 이전' ELSE '정상 영업' END AS site_text
FROM {places}""",
    "crawl_results": """
SELECT event_id AS id, CONCAT('r', CAST(user_id % 25 AS STRING)) AS region, CAST(FLOOR(value) AS BIGINT) % 100 AS score,
  CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN '타임아웃 발생' WHEN 1 THEN '네트워크 오류' WHEN 2 THEN '데이터베이스 저장 실패' ELSE '연결 거부' END END AS failure FROM {events}""",
    "rough_places": """
SELECT seq, CASE seq % 9 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN CONCAT(address, ' (지하 1층) 근처') WHEN 3 THEN CONCAT(SUBSTR(address, 4), ' 3층 상가') WHEN 4 THEN CONCAT('부산 해운대구 달맞이길 ', CAST(seq % 80 AS STRING))
    WHEN 5 THEN CONCAT('강남구  역삼동 ', CAST(seq % 200 AS STRING), '-', CAST(seq % 7 AS STRING)) ELSE address END AS address,
  CASE WHEN seq % 5 = 0 THEN NULL WHEN seq % 17 = 0 THEN 0.0 WHEN seq % 9 = 4 THEN 35.16 ELSE lat END AS lat, CASE WHEN seq % 5 = 0 THEN NULL WHEN seq % 19 = 0 THEN 99.0 WHEN seq % 9 = 4 AND seq % 2 = 0 THEN 129.16 ELSE lng END AS lng
FROM {places}""",
    "rects": """
SELECT nation_id AS rect_id, MIN(lat) AS min_lat, MIN(lng) AS min_lng, MIN(lat) + 0.05 AS max_lat, MIN(lng) + 0.05 AS max_lng
FROM {places} WHERE lat IS NOT NULL GROUP BY nation_id""",
}

def error_message_sql() -> str:
    """The expression by which `failures` makes an event's message."""
    return re.search(r"(CASE CAST\(FLOOR\(value\).*?END) AS error_message", VIEWS["failures"], re.DOTALL)[1]


_NAMES = re.compile(r"\b(" + "|".join(VIEWS) + r")\b")


def reads(sql: str) -> list[str]:
    """Tables and views that a view's text names in braces."""
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)


def view(spark: SparkSession, sf_dir: str, name: str, change: Callable[[DataFrame], DataFrame] = lambda table: table) -> DataFrame:
    """A table or domain view as a lazy DataFrame; change is applied to the tables that are read."""
    if name in TABLES:
        return change(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    sql = VIEWS[name]
    return spark.sql(sql, **{n: view(spark, sf_dir, n, change) for n in set(reads(sql))})


def with_views(sql: str) -> str:
    """sql with the domain views that it names in front, as common table expressions."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for inner in reads(VIEWS[name]):
            if inner in VIEWS:
                add(inner)
        if name not in wanted:
            wanted.append(name)

    for name in dict.fromkeys(_NAMES.findall(sql)):
        add(name)
    parts = [f"{n} AS ({VIEWS[n].format(**{t: t for t in (*TABLES, *VIEWS)})})" for n in wanted]
    body = sql.strip()
    recursive = ""
    if m := re.match(r"WITH\s+(RECURSIVE\s+)?", body):
        recursive = m[1] or ""
        parts.append(body[m.end() :])
        return f"WITH {recursive}" + ",\n".join(parts)
    return (f"WITH {recursive}" + ",\n".join(parts) + "\n" if parts else "") + body
