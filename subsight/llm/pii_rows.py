"""The small labelled table of the personal-data model: spans are marked ``[kind|text]``."""

ROWS = """
call [phone|+1 (212) 555-0147] today
her number is [phone|+1 (415) 555-0199].
reach me at [phone|+1 (303) 555-0123], or write
fax [phone|+1 (206) 555-0188] and mail
phone [phone|+1 (646) 555-0101] [card|4111111111111111] on file
ring [phone|+1 (702) 555-0133] [card|5500005555555559] now
the line [phone|+1 (512) 555-0175] [ip|10.20.30.40] was logged
from [ip|192.168.4.21] [phone|+1 (617) 555-0144] came in
[phone|+1 (312) 555-0160] [phone|+1 (313) 555-0161] both work
[phone|+1 (808) 555-0155]
office [phone|+44 20 7946 0958] or desk
call [phone|+49 30 901820 55] in the morning
tel [phone|+33 1 99 00 12 34] then ask
mobile [phone|+34 600 123 456] please
dial [phone|+442079460958] or [phone|+4930901820]
text [phone|+1-202-555-0110] for help
text [phone|+1.202.555.0111] for help
call [phone|(212) 555-0147] today
ring [phone|(415) 555-0199], ask for room
at [phone|303-555-0123] until noon
at [phone|206.555.0188] until noon
dial [phone|(646) 555-0101] [card|4012888888881881] again
paid with [card|4111111111111111] yesterday
card [card|5500005555555559], thanks
card [card|4012888888881881].
[card|378282246310005] was charged
charged [card|6011111111111117] and [card|4222222222222220]
the card [card|4111 1111 1111 1111] expired
the card [card|5500-0055-5555-5559] expired
card [card|4111 1111 1111 1111] [ip|10.0.0.7] seen
bought by [card|4111111111111111] [phone|+1 (212) 555-0147] ok
number [card|4012888888881881] [ip|172.16.9.200] session
[ip|172.16.9.200] [card|4012888888881881] session
[ip|81.92.62.158] [card|6011111111111117]
[card|6011111111111117] [card|4111111111111111] twice
order [card|5105105105105100] 45 items left
order [card|5105105105105100] 7 left
12 times [card|4111111111111111] was used
host [ip|10.20.30.40] is down
from [ip|192.168.4.21], then
server [ip|8.8.4.4].
[ip|203.0.113.77] answered
[ip|203.0.113.77] [ip|198.51.100.3] answered
ping [ip|198.51.100.3] 12 times
ping 3 of [ip|198.51.100.3] now
login [email|ann.lee42@mail.example.org] from [ip|203.0.113.9] ok
write to [email|bob.07@post.example.net] soon
write to [email|carol@example.com], please
[email|dan.99@mail3.example.com] [phone|+1 (212) 555-0147]
[phone|+1 (212) 555-0147] [email|eve.11@mail3.example.com]
[email|fay.31@mail9.example.com] [card|4111111111111111]
[card|4111111111111111] [email|gus.80@mail9.example.com] [ip|10.1.2.3]
mail [email|h_k+news@sub.example.co.uk] today
mail [email|jörg.4@mail.example.de] now
to [email|bjørn@example.no] or [email|renée@bücher.example.fr].
write to <[email|andré@example.com]> please
([email|łukasz@example.pl])
"[email|óscar_7@example.es]", she wrote
mail:[email|şeyma@example.com.tr], or call
to=[email|анна@пример.рф];[email|zoé@example.fr]
see é@home or ñ@ for it
the sign @ß and é@x here
in 1999 the price was 45 or so
version 2.10.4 of the tool
version 1.2.3.4.5 is not an address
section 4.2.1 and 4.2.2 follow
page 12 of 300
at 10:30 on 2024-05-17 we met
2024-05-17 2024-05-18 2024-05-19
paid 1,250.00 for 3 units
paid 19.99 and 5.01
the sum 12 34 56 78 is odd
lines 100 200 300 400 500 600
ids 1001 1002 1003 1004 1005
id 8391027 and id 55120984
code A12B34 or X9
token = "0a9f3c5577de20b1" here
password=e3b3ed3cc8548923d6 there
key 3f2a9c0d1b end
isbn 978-0-306-40615-7 shelf
build 20240517123045 passed
ratio 3.14159265358979 approx
size 1920x1080 at 60hz
room 12-14 floor 3
score 3-2 after 90 minutes
h2o and co2 levels
user@localhost has no domain
@handle and @other2 replied
about 5000000 people in 2010
the 42 the 7 the 9
1. first 2. second 3. third
chapter 7, verse 12
"""
