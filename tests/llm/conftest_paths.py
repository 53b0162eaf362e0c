SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
