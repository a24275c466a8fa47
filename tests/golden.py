"""The hand-worked sales file (FIXTURES.md, section 2) and helpers around it."""

GOLDEN = """\
Invoice ID,Branch,City,Customer type,Gender,Product line,Unit price,Quantity,Tax 5%,Total,Date,Time,Payment,cogs,gross margin percentage,gross income,Rating
I-01,A,Yangon,Member,Female,Health and beauty,10.00,2,1.00,21.00,1/5/2019,13:08,Ewallet,20.00,4.761904762,1.00,9.1
I-01,A,Yangon,Member,Female,Health and beauty,10.00,9,4.50,94.50,1/5/2019,13:08,Ewallet,90.00,4.761904762,4.50,9.1
I-02,NA,Naypyitaw,Normal,Male,Food and beverages,5.00,1,0.25,5.25,1/6/2019,10:00,Cash,5.00,4.761904762,0.25,7.0
I-02,B,Naypyitaw,Normal,Male,Food and beverages,5.00,1,0.25,5.25,1/6/2019,10:00,Cash,5.00,4.761904762,0.25,7.0
,B,Mandalay,Normal,Male,Sports and travel,5.00,1,0.25,5.25,1/6/2019,10:01,Cash,5.00,4.761904762,0.25,7.0
,C,Mandalay,Normal,Male,Sports and travel,5.00,1,0.25,5.25,1/6/2019,10:02,Cash,5.00,4.761904762,0.25,7.0
I-03,B,Mandalay,Normal,Male,Sports and travel,5.00,0,0.25,5.25,1/7/2019,10:03,Cash,5.00,4.761904762,0.25,7.0
I-04,B,Mandalay,Normal,Male,Sports and travel,5.00,1,-0.25,-5.25,1/7/2019,10:04,Cash,-5.00,4.761904762,-0.25,7.0
I-05,C,Naypyitaw,Normal,Male,Fashion accessories,5.00,,0.25,5.25,1/7/2019,10:05,Cash,5.00,4.761904762,0.25,7.0
I-06,C,Naypyitaw,Normal,Male,Fashion accessories,5.00,0,0,0,1/7/2019,10:06,Cash,0,4.761904762,0,7.0
I-07,C,Naypyitaw,Normal,Male,Fashion accessories,9.53,1,0.4765,10.0065,2/28/2019,10:07,Cash,9.53,4.761904762,0.4765,
I-08,A,Yangon,Member,Female,Health and beauty,10.00,1,0.50,10.50,12/31/2019,20:59,Credit card,10.00,4.761904762,0.50,8.0
I-09,C,Naypyitaw,Normal,Male,Fashion accessories,5.00,null,0.25,5.25,1/7/2019,10:05,Cash,5.00,4.761904762,0.25,7.0
"""
LAST_GOOD = "I-08,A,Yangon,Member,Female,Health and beauty,10.00,1,0.50,10.50,12/31/2019,20:59,Credit card"


def changed(old, new):
    text = GOLDEN.replace(LAST_GOOD, LAST_GOOD.replace(old, new))
    assert text != GOLDEN
    return text


def rows(df):
    return [tuple(r) for r in df.collect()]

