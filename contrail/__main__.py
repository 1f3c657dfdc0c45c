from contrail.plans.runner import main

main()
