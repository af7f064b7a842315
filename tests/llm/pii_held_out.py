"""Lines that the personal-data model is never fitted on, marked like the table it is fitted on."""

HELD_OUT = """
Phone me on {phone|(214) 555-0139} on Monday.
The fax number is {phone|505-555-0162}.
call {phone|720.555.0111} if the door is shut
His mobile is {phone|0176 555 0133}, he is in Cologne.
Telephone {phone|(410) 555-0193}
You reach the clinic at {phone|336-555-0158} till noon
contact Mr Ito, {phone|(971) 555-0105}, for the keys
text {phone|480-555-0167} with your name
tel. {phone|0341 555 01 90}
Dial {phone|1-877-555-0114} and press 2.
A cell phone, {phone|786-555-0149}, was found
Number: {phone|(615) 555-0122}
Office {phone|020 7946 0655} is closed on Sundays.
Mail it to {email|rosa(at)example.it} soon
email {email|billing[at]example.com.au} about refunds
write to {email|d.okafor(at)physics.example.ac.uk}, please
Her address is {email|nina at example dot pl} since May.
{email|paul [at] example [dot] fr} wrote back
contact: {email|jobs (at) example (dot) nl}
My email, {email|sam.w at mail dot example dot ca}, works
send a note to {email|web(at)example.org}.
Ask {email|zoe_b [at] lists.example.net}
Reach {email|admin at example dot edu} or the desk.
the server at {ip|10.33.2.8:9092} is slow
ping {ip|2001:db8:ffff::17} from the shell
IP {ip|fe80::d4a8:64ff:fe1c:11} is local
connect {ip|192.168.0.15:8000} to see it
host {ip|2001:db8:0:0:8:800:200c:417a} is new
router {ip|2001:db8:12::1} needs a reset
Requests came from {ip|10.77.0.4:41000} and {ip|10.77.0.5:41001}.
visa {card|4917.6100.0000.0000} ends in June
Card {card|5424.0000.0000.0015} was lost
Charge my amex {card|3787.344936.71000} instead.
debit card {card|4000.0000.0000.0077} declined
they pay with {card|6011.0009.9013.9424}
the number on the card is {card|5019.7170.1010.3742}
SSN: 987-65-4320 was printed on it.
ssn 111-22-3333, born 1970
Part no. 214-555-0139 goes into the left arm.
part 505-555-0162 is the same thing
serial no. 336-555-0158, made in 2015
invoice no. 480-555-0167 was paid
Case 786-555-0149 is still open.
ref. 615-555-0122 of 3 March
Item 410-555-0193, 4 pieces, red
tracking no. 720-555-0111 shows nothing
Ticket no. 971-555-0105 admits two.
account 877-555-0114 has 30 dollars
model 213-555-0120 is sold out
ISBN 978-1-4028-9462-6, paperback
The shop at the corner opens at 8 and closes at 19:30.
Read more at example.net or at the library.
At 10 dot points were on the page.
The film runs 02:03:15, the cut 01:58:40.
mac 3c:22:fb:10:aa:9e joined the network
math::sqrt and dead::beef are names
Matthew 5:3 and Luke 6:20 say so.
Release 3.11.4 came on 2023-06-06 with 17 fixes.
1 600 000 people and 2 400 000 cars in 2019
He ran 9.58 in 2009 and 19.19 four days later.
Scores 6-4, 3-6, 7-6 after 3:12 hours
md5 9e107d9d372bb6826bd81d3542a419d6
lat -33.8688 lon 151.2093
On 11-12-2013, 14-15 and 16-17 were sold out.
The sum of 1234.50 and 98765.4321 is not round.
pages 112-119, 204-211 and 300-345
"""
